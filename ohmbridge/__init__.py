"""A PySpark-native data-quality, entity-resolution and reporting engine."""

__version__ = "0.1.0"
