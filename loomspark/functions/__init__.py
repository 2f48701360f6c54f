"""functions of loomspark."""
