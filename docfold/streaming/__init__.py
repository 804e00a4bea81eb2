"""Streams of pages and events."""
