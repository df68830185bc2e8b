"""A Spark-native analytics engine: declarative DataFrame operators over security feeds."""
