"""Readers, writers, named SQL and governed selects."""
