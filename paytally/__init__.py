"""Daily payment-activity analytics as plain Spark DataFrame jobs."""
