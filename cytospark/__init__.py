"""A PySpark-native engine for single-cell count-matrix analytics."""
