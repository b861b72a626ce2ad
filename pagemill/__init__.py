"""Encrypted document ingestion, masking, retrieval and evaluation as Spark jobs."""
