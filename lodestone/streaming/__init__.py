"""Structured Streaming forms. The blueprint has no streams: these are extensions, not parity."""
