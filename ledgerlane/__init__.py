"""Investment tracking for many portfolios at once, as Spark DataFrame jobs."""
