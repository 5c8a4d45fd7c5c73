"""Table functions for SQL."""
