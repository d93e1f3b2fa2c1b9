"""PySpark-native engine for research-literature knowledge bases and training corpora."""
