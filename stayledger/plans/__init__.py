"""Whole jobs: the daily extract and the wide booking extract."""
