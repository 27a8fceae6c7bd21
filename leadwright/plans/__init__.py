"""Composed jobs: feature stages, training, daily scoring and the query catalogue."""
