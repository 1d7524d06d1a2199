"""Partitioned tables and the metrics index."""
