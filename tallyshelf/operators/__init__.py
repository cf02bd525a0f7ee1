"""Relational steps shared by the plans."""
