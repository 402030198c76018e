"""quillfeed: a Spark-native engine for landed feed pages and text corpora."""
