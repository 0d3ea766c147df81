"""End-to-end queries composed from the operators."""
