"""Batch and streaming operators over ticks, bars and served entries."""
