"""Company analytics warehouse on Spark: staging, warehouse, marts, quality and run log."""
