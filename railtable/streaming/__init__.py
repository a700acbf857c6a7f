"""Streaming of the rail-network engine."""
