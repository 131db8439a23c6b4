"""A PySpark-native engine for reaction records and text corpora."""
