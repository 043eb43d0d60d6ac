"""textveil: a PySpark-native engine for clinical text de-identification,
entity evaluation and corpus preparation."""

__version__ = "0.1.0"
