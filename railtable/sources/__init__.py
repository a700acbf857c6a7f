"""Sources of the rail-network engine."""
