"""Readers and writers of files, warehouse and relational tables."""
