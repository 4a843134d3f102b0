"""DataFrame operators of the intake flow."""
