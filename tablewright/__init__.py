"""tablewright: Spark-native extraction and auditing of tables from landed web pages."""
