"""Column functions: built-in expressions only, usable on batch and streams."""
