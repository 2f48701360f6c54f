"""plans of loomspark."""
