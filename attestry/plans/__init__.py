"""Models and saved analyses."""
