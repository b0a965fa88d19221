"""Jobs and the query registry."""
