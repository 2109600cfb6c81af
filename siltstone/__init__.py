"""Spark jobs that turn compressed JSON-lines archives into Parquet tables and
searchable text indexes."""

from siltstone.operators.filters import FilterSpec
from siltstone.plans.ingest import ingest

__all__ = ["FilterSpec", "ingest"]
