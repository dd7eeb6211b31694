"""Plan shapes shared by the operators, and the query catalogue."""
