"""The same checks on rows that keep arriving."""
