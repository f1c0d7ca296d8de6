"""Scans: header tables, wide matrices, attribute lines, file catalogues."""
