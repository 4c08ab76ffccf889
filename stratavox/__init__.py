"""Spark-native analytics for chunked 3-D image and label volumes."""
