"""Column functions: pure expressions, no actions, no Python in the execution path."""
