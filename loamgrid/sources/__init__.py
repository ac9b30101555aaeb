"""Readers, fixtures and sinks."""
