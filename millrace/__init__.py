"""PySpark-native dataset curation and analytics."""
