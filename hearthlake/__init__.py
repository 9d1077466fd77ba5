"""Retail lakehouse analytics on Spark: curated datasets, business metrics,
embedded quality checks and a distributed sales forecast."""

__version__ = "0.1.0"
