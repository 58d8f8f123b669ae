"""Document-to-tables analytics on Spark."""
