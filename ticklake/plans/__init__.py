"""Compositions users run: the medallion layer table (``medallion``), the
ingestion job (``ingest``), the per-layer job entry point (``jobs``), the
test-data adapter over the driver tables (``testdata``) and the registered
queries with their DuckDB oracles (``catalog``, ``oracle``)."""
