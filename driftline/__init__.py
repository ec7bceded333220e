"""driftline: incremental text-diff processing on Spark."""
