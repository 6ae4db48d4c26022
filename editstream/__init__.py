"""editstream: Spark-native analytics for streams of collaborative-edit events."""

__version__ = "0.1.0"
