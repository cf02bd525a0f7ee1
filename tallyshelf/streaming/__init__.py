"""Structured Streaming entry for recurring crawl runs."""
