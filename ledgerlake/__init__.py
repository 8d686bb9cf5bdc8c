"""Layered sales warehouse on Spark: raw, staging, star schema, marts, quality."""
