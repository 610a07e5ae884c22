"""Spark-native tables for a city's events and merchant offers."""

__version__ = "0.1.0"
