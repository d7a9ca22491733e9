"""sievemill: a Spark-native engine for covering, recording and reconciling
data that is only seen through capped, repeated and partial reads."""
