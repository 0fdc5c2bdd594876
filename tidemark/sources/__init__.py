"""Readers, feed adapters and writers."""
