"""Operators of a training-data pipeline. Nothing else in the library imports this package; the folder can be deleted."""
