"""Jobs over stored tables, and the queries registered for checking."""
