"""Frame to frame operators: keys, dimensions, fact, enrichment, marts, checks."""
