"""The engine's operators on the given tables, with SQL twins for checking."""
