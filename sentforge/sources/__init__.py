"""File readers and writers."""
