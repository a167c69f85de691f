"""DataFrame operators and Spark ML stages."""
