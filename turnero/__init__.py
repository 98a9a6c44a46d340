"""Turnero: Spark operators for appointment-booking marketplaces."""

__version__ = "0.1.0"
