"""murmur: analytics over forum posts and comments as Spark DataFrame operators."""
