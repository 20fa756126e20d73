"""Folianta: corpus preparation, vocabularies, vectors and evaluation as Spark jobs."""
