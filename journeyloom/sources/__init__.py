"""Readers, adapters and sinks."""
