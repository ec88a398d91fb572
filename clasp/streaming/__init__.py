"""Structured Streaming: decode, validate, score and sink."""
