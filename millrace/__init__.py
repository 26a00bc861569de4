"""Spark-native engine for building and analysing language-model distillation data."""

__version__ = "0.1.0"
