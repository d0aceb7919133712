"""Structured Streaming operators: alert/message streams, replay, state."""
