"""tallyflow: usage metering and billing analytics as Spark DataFrame jobs."""
