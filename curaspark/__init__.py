"""Spark-native curation of versioned record stores and text corpora."""
