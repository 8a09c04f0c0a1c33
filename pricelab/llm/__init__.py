"""Operators that prepare training text, each over a table of documents or conversations."""
