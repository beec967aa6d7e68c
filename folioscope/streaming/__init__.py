"""Change feeds between versions of a table."""
