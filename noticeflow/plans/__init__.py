"""Whole plans: the run's three steps, and one query for each operator."""
