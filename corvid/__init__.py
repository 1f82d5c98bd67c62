"""Corvid: a Spark-native engine that turns captured web pages and feeds into a clean corpus of article records."""
