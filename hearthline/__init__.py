"""Listing-history analytics as Spark jobs: sources, column functions, operators, plans and streams."""
