"""Preparation, rollups and reports composed from the operators."""
