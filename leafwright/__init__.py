"""Leafwright: a Spark-first engine for scholarly documents."""
