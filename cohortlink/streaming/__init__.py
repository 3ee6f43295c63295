"""Incremental (availableNow) intake over a drop folder."""
