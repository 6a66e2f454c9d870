"""Composed datasets."""
