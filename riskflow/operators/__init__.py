"""DataFrame operators: cleaning, dimensions, skew-safe joins, statistics, checks and fault injection."""
