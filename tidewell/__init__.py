"""Tidewell: a Spark-native engine for offer ingestion, scoring, querying and payment evaluation."""
