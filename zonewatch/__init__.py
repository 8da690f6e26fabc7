"""Zone-level sensor analytics on Spark: alerts, trends, daily tables, reports and dashboard queries."""
