"""Shelfline: demand-panel and order-line analytics written as Spark DataFrame operators."""

__version__ = "0.1.0"
