"""Keyed merge, ingest strategies, quotas, customer reference and lineage."""
