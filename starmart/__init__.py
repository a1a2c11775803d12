"""Flat retail sales to a star schema and sales marts, as Spark jobs."""
