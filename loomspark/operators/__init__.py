"""operators of loomspark."""
