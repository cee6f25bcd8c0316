"""Corpus preparation and publishing as Spark jobs."""
