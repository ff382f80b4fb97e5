"""Reusable multi-step operators built from DataFrame joins, aggregates and windows."""
