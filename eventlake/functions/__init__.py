"""Column functions that Spark does not ship."""
