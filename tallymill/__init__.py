"""Batch and streaming analytics jobs on PySpark, planned for skewed keys."""
