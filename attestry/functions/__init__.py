"""Column helpers and the detection rule catalogue."""
