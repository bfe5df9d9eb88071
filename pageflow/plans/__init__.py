"""Whole jobs: the edge store, month ingest, and the catalog of registered queries."""
