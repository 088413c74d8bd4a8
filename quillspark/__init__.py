"""Document analytics on Spark: composable DataFrame operators for document corpora."""

__version__ = "0.1.0"
