"""linkloom: a Spark-native engine for identifier audits and record linkage."""
