"""Operators of a training-data pipeline; nothing else of the package imports this folder."""
