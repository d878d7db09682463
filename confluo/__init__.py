"""Entity resolution, account health and data-quality analytics as lazy Spark plans."""

__version__ = "0.1.0"
