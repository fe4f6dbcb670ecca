"""Spark-first analytics over block-partitioned volumes, region graphs, skeletons and contact graphs."""
