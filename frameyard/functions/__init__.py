"""frameyard functions."""
