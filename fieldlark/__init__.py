"""fieldlark: Spark-native operators for evidence-quality tables and training-data preparation."""

__version__ = "0.1.0"
