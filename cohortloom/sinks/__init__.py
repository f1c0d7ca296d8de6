"""Sinks: tables, summaries and feature vectors."""
