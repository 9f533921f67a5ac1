"""File-stream versions of the log operators."""
