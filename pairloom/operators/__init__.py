"""pairloom.operators: Spark-native record linkage."""
