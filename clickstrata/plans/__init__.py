"""The same aggregates and reports as Spark SQL, and the jobs that build the tables."""
