"""Audience profiling on Spark: change records, page logs and orders in, user tags and age-bucket scores out."""
