"""Spark jobs that build repeatable technical evidence about forest change in supply chains."""

__version__ = "0.1.0"
