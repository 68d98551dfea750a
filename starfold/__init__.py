"""Turn denormalised statistical CSV archives into star schemas on Spark."""

__version__ = "0.1.0"
