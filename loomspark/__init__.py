"""Loomspark: a PySpark-native engine that builds language-model training corpora."""

__version__ = "0.1.0"
