"""Structured Streaming forms: file-fed streams, keyed state processors, sinks."""
