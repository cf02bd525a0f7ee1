"""Retail catalogue snapshots and marketplace ledgers as Spark jobs."""
