"""orrery: a PySpark-native engine for labelled items that carry embedding vectors."""
