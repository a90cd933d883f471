"""Whole queries (DataFrame -> DataFrame) and their registry / SQL oracles."""
