"""Text and CSV readers and writers."""
