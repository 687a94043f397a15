"""Readers, blob intake and sinks."""
