"""pairloom.plans: Spark-native record linkage."""
