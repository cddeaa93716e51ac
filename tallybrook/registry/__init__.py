"""Every operator as a query over the driver tables, with the SQL that checks it."""

from tallybrook.registry import (  # noqa: F401  (importing registers the queries)
    ingest_queries,
    lake_queries,
    model_queries,
    quality_queries,
    streaming_queries,
)
from tallybrook.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
