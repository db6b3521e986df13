"""Structured Streaming: status events -> alerts -> replay-safe history."""
