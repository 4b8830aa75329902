"""DataFrame operators of the monthly panel engine."""
