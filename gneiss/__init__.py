"""A Spark-native engine for registries and profiles of document corpora."""
