"""Readers, catalog and sinks."""
