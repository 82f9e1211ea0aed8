"""A PySpark-native analytics engine for tile and cell cohorts."""
