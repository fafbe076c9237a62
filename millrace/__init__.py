"""millrace: a PySpark-native engine that turns messy records into clean, keyed, deduplicated tables."""
