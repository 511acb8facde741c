"""Spark-native ledger ingest, sales register and order-to-cash analytics."""
