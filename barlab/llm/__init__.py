"""Operators of a training-data pipeline on whole document tables.  Nothing else
in the library imports this package."""
