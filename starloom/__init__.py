"""Image sessions and training text as Spark jobs."""

__version__ = "0.3.0"
