"""Continuous ingestion with the same merge rules as a batch."""
