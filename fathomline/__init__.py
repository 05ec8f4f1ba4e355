"""Planetary sounding-radar analytics on Spark."""
