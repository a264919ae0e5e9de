"""Daily demand features, forecasts and monitoring as plain Spark jobs."""

__version__ = "0.1.0"
