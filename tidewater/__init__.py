"""Analytics operators written as Spark DataFrame jobs."""
