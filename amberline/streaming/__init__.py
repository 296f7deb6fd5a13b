"""Structured Streaming: deduplicate and score an arriving feed."""
