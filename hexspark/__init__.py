"""A PySpark-native engine for map coverage and population analytics on a hexagonal grid."""
