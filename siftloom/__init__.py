"""Spark-first analytics over aligned reads and gene annotations."""
