"""sigmill: a PySpark-native engine that turns raw observations of many entities into quality indices."""
