"""Operators of the rail-network engine."""
