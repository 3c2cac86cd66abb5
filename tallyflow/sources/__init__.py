"""Readers for landed files and the layered table store."""
