"""Feeds end to end, staging of shared intermediates, and fan-out to tables."""
