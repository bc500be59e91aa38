"""Whole jobs composed from the operators: catalog, publication, validation."""
