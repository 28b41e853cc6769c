"""DataFrame operators. Each takes frames and returns a lazy frame."""
