"""Whole jobs on the star schema: load, flat panel, views, report cards and training."""
