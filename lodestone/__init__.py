"""A Spark-native engine for model registries, artifact catalogs and machine-learning datasets."""
