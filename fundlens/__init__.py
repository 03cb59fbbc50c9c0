"""fundlens: a PySpark-native engine for public-budget designation data."""
