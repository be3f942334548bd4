"""A Spark-native engine for curating acquired web, feed and document payloads."""
