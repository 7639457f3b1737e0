"""Streaming forms: results of a poll, heartbeats and stalls, with watermarks and bounded state."""
