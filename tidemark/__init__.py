"""Change-data order analytics, written as Spark DataFrame jobs."""
