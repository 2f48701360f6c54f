"""sources of loomspark."""
