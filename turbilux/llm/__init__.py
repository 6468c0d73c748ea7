"""Operators for training-data pipelines over text tables, with their registered queries in ``queries``."""
