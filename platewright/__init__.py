"""Microplate imaging tables on Spark."""
