"""Yield model on MLlib."""
