"""Structured Streaming jobs. They reuse the batch expressions and stop at bars: offset windows are
not defined on streams, so features run on stored bars."""
