"""Readers of tables, landed payloads and exported logs, and the sinks."""
