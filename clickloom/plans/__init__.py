"""Whole jobs: several analyses over one scan, with their writes."""
