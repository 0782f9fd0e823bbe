"""Table jobs on Spark: lifecycle ranges, change-log snapshots, hub tables, extracts and cells."""
