"""Spark-native engine for multilingual content processing and quality control."""
