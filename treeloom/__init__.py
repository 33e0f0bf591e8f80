"""treeloom: source-tree analytics as Spark DataFrame jobs."""
