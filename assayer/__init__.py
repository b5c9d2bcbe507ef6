"""A Spark-native engine for evaluating document deliverables: scoring, ranking, reporting."""
