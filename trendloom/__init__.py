"""Span trends on Spark: counts and latency statistics per service and operation."""
