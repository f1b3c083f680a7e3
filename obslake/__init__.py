"""obslake: a PySpark-native engine for time-stamped station observations."""
