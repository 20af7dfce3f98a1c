"""frameyard operators."""
