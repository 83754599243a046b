"""loomlake: a Spark-native tick-data lakehouse with governed scans, audits and training-data operators."""
