"""Daily response analytics on day-partitioned tables, written as Spark DataFrame jobs."""
