"""Page text in, linked relational tables out: a Spark-native document ETL."""
