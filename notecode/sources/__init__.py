"""Readers and writers: parquet tables, shared staging tables, versioned targets, ontology files."""
