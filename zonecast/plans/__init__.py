"""The jobs: preparation, training, prediction and the hourly cycle."""
