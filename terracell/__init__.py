"""Geographic variables for analysis units, as Spark DataFrame jobs over whole layers."""
