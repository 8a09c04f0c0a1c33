"""Readers. Paths are Hadoop paths or lists of them, globs included."""
