"""Column expressions: keys, measures, latency statistics."""
