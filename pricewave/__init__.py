"""Price-history analytics as Spark DataFrame operators."""
