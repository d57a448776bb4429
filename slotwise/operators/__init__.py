"""DataFrame operators: every function takes frames and returns a lazy frame."""
