"""Standardised indices for environmental monitoring series, as Spark DataFrame operators."""

__version__ = "0.1.0"
