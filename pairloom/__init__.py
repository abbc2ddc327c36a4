"""pairloom: a Spark-native record-linkage engine (DataFrame / Catalyst first)."""
