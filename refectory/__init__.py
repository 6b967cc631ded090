"""Catering analytics on Spark."""
