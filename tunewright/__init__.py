"""Spark-native preparation and analysis of fine-tuning corpora."""
