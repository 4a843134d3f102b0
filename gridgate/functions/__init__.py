"""Column builders: no actions, no UDFs."""
