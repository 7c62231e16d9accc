"""Article analytics on Spark: landed feeds and web pages in, metric rows out."""
