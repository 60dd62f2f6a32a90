"""notecode: a PySpark-native engine for clinical text extraction, coding and data quality."""
