"""A PySpark-native engine for curating bibliographic and text corpora."""
