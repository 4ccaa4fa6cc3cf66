"""PySpark-native engine for segment-and-evidence analytics."""
