"""Veristrata: declarative data-quality validation on Spark."""
