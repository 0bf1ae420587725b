"""Structured Streaming jobs over the per-card state."""
