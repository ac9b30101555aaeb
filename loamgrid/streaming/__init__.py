"""Streams of new tiles."""
