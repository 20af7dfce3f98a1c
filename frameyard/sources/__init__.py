"""frameyard sources."""
