"""tamis: Spark-native curation of fine-tuning corpora."""

__version__ = "0.1.0"
