"""Structured Streaming forms of the operators that need watermarks or keyed state."""
