"""lexiframe: document analytics, stylometry and text classification as Spark jobs."""

__version__ = "0.1.0"
