"""PySpark-native preparation and audit of large document corpora."""
