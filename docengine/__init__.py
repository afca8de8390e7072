"""A Spark-native engine for document conversion and document tables."""
