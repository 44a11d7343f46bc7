"""Reads and jobs composed from operators."""
