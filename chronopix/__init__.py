"""Temporal statistics over gridded observations, on Spark."""
