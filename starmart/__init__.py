"""starmart: star-schema maintenance and market-basket mining as PySpark DataFrame operators."""

__version__ = "0.1.0"
