"""Star-schema analytics over border-arrival records, as Spark DataFrame operators."""
