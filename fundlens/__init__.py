"""fundlens: a Spark-native engine for development-finance project data."""

__version__ = "0.1.0"
