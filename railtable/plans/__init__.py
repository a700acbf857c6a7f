"""Plans of the rail-network engine."""
