"""linkloom: a Spark-native archive of links, its search layer and its publishing steps."""
