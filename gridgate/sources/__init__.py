"""Scans of files and tables into rows that keep their file and position."""
