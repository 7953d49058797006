"""PySpark-native analytics for document and question corpora."""
