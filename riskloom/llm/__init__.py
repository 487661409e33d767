"""Operators for preparing the texts of a large training corpus."""
