"""Column functions: text, shell commands, paths and JSON."""
