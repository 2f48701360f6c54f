"""streaming of loomspark."""
