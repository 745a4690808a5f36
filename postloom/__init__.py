"""postloom: a PySpark-native engine for job postings, their keywords and their texts."""

__version__ = "0.1.0"
