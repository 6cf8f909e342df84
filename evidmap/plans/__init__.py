"""Jobs, the analytics registry and the query catalogue with its oracle SQL."""
