"""Column functions: they build expressions and never touch rows in Python."""
