"""Operators of a training-data pipeline; see README.md in this folder."""
