"""pairloom.streaming: Spark-native record linkage."""
