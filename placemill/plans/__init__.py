"""Layer plans, and the queries registered for checking."""
