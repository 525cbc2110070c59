"""Column builders: pure expressions, no actions, no Python UDFs."""
