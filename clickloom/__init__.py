"""Clickstream and ad-click analytics, written as Spark DataFrame plans."""
