"""Readers and writers of frame records and tables."""
