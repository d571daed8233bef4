"""Operators that prepare large text collections for training, and their registered queries."""
