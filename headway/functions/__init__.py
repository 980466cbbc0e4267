"""Column expressions: clock strings, labels, geometry, delay measures, rounded statistics."""
