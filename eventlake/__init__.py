"""eventlake: land event streams in lake tables with PySpark."""
