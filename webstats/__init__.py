"""webstats: a Spark-native web-analytics engine."""
