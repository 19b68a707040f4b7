"""Fixture projections, stored layers and the query registry."""
