"""shopweave: the daily data work of an online shop, as Spark DataFrame jobs."""
