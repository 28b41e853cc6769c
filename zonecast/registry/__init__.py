"""The queries of the driver contract over the driver's tables, with their SQL."""
