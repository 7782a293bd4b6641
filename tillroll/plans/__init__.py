"""Whole runs: read lines, apply operators, write every result."""
