"""Review sentiment analytics as Spark DataFrame, ML and streaming jobs."""
