"""Where series tables go."""
