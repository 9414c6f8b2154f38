"""Ordered replay of events into a file-stream source folder (stand-in for the topic).

Chunks arrive one after another, in event-time order; each arrival is followed by one
availableNow run of the stream on the same checkpoint, the way a scheduled job drains what
has arrived. Chunk files are written by Spark in parallel (no single-task funnel)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferlake.session import shared_dir
from transferlake.sources.events import encode_events


def event_payloads(events: DataFrame, fields: list[str]) -> DataFrame:
    return encode_events(events, fields)


def chunk_of(events: DataFrame, n_chunks: int, ts_col: str = "timestamp"):
    """Chunk number 0 .. n_chunks - 1 of an epoch-seconds column: equal spans of the event time
    the table covers, however many days or months that is. Rows without a time come first."""
    span = events.agg(F.min(ts_col).alias("first"), F.max(ts_col).alias("last")).first()
    if span["first"] is None:
        return F.lit(0)
    whole = span["last"] - span["first"] + 1
    return F.coalesce(F.floor((F.col(ts_col) - span["first"]) * n_chunks / whole), F.lit(0))


def write_chunk(events: DataFrame, chunk_expr, k: int, fields: list[str], src_path: str,
                copy: int = 0) -> None:
    """Write chunk k's payloads; ``copy`` > 0 writes another delivery of the same events."""
    part = events.where(chunk_expr == k)
    folder = f"chunk={k:03d}" + (f"-copy{copy}" if copy else "")
    event_payloads(part, fields).write.mode("overwrite").text(f"{src_path.rstrip('/')}/{folder}")


def replay(events: DataFrame, chunk_expr, n_chunks: int, fields: list[str], src_path: str, after_chunk,
           order: list[int] | None = None, redeliver: set[int] | None = None) -> None:
    """Deal the events into chunks (once, as a table partitioned by chunk in the shared folder),
    then write chunk k and call ``after_chunk(k)`` (run the stream), for k in ``order``
    (0..n-1 by default; another order makes chunks arrive late). Chunks in ``redeliver`` are
    delivered twice in the same arrival (at-least-once sources do that)."""
    staged = shared_dir(events.sparkSession, "replay", unique=True)
    dealt = events.withColumn("_chunk", chunk_expr.cast("bigint"))
    dealt.write.partitionBy("_chunk").parquet(staged)
    dealt = events.sparkSession.read.schema(dealt.schema).parquet(staged)
    for k in (order if order is not None else range(n_chunks)):
        write_chunk(dealt, F.col("_chunk"), k, fields, src_path)
        if redeliver and k in redeliver:
            write_chunk(dealt, F.col("_chunk"), k, fields, src_path, copy=1)
        after_chunk(k)
