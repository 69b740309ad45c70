"""Monthly programming-language activity ratings as Spark DataFrame jobs."""
