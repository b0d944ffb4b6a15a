"""Structured Streaming: metrics, serving and chronological replay."""
