"""Functions of the rail-network engine."""
