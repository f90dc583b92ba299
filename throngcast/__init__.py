"""Station congestion analytics expressed as Spark DataFrame operators."""
