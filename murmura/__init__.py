"""Opinion mining and text search over discussion comments, as Spark DataFrame operators."""
