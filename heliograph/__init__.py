"""Photovoltaic telemetry analytics written as Spark DataFrame transforms."""

__version__ = "0.1.0"
