"""DataFrame operators: each takes frames and column names and returns a frame."""
