"""Runs and sinks built from the operators."""
