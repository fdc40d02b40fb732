"""Fraud model on Spark MLlib."""
