"""Event lakehouse jobs on Spark: zipped feed files to a tested star schema."""
