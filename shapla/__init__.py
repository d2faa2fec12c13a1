"""shapla: a Spark-native engine for building, cleaning, searching and evaluating a web corpus."""
