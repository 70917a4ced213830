"""Readers of raw records and extractors of list pages."""
