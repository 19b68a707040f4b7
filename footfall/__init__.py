"""Footfall: people-tracking analytics as plain PySpark DataFrame functions."""
