"""Spark jobs that learn and watch per-user category preferences from rating data."""
