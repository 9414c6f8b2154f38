"""The full query registry: batch, table (write and read back) and streaming queries."""

from __future__ import annotations

from transferlake.plans import batch, streams, tables
from transferlake.plans.oracle import ORACLE


def all_queries() -> dict:
    q = dict(batch.QUERIES)
    q.update(tables.QUERIES)
    q.update(streams.QUERIES)
    return q


def all_oracles() -> dict:
    q = all_queries()
    return {k: v for k, v in ORACLE.items() if k in q}
