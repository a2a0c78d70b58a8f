"""PySpark-native analytics for agent traffic: wire frames in, one row per model response out."""
