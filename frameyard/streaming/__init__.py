"""frameyard streaming."""
