"""Scans: landed web pages and exported workbooks."""
