"""corpusprep: Spark-native preparation of language-model training data and run-log analytics."""

__version__ = "0.1.0"
