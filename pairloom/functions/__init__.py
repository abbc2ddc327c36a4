"""pairloom.functions: Spark-native record linkage."""
