"""Relational, transcript, redaction, scoring and reporting operators."""
