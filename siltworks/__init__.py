"""Spark-native curation engine for question/answer and text corpora."""

__version__ = "0.1.0"
