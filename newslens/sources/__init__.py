"""Readers and writers: feeds, topics, tables and metric rows."""
