"""Spark-native analytics over tiled images, their detections and text corpora."""
