"""A Spark-native engine that turns technical specifications into a queryable knowledge base."""
