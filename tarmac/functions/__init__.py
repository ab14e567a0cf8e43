"""Column-level building blocks: role resolution, expressions, tail probabilities."""
