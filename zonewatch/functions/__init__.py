"""Column builders: times, tolerant casts, bands, grading rules, routing, statistics."""
