"""sourcetrail: evidence extraction, findings and review integrity as Spark DataFrame operators."""
