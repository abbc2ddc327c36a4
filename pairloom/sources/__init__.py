"""pairloom.sources: Spark-native record linkage."""
