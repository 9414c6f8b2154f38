"""End-to-end jobs: landing CSV -> good table load + dead letters, the streaming job, alerts and
the publisher."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transferlake.operators import cleaning
from transferlake.schemas import LANDING_DDL, LARGE_TRANSFER_THRESHOLD
from transferlake.session import shared_dir, stored
from transferlake.sources import landing
from transferlake.sources import tables as tb


def load_landing(spark: SparkSession, landing_path: str, table_path: str, dlq_path: str,
                 load_id: int, operation: str = "append", only_new: bool = False) -> dict:
    """Landing files are read and tagged once, into a staging table in the shared folder split by
    route; both outputs are published from it: dead letters first (each load's in a folder of
    its own, so a rerun overwrites them), then the good rows, whose load record comes last.
    Either side may be empty.

    ``only_new`` reads only files that no earlier load of the table has read (by path, size and
    modification time): the table keeps a manifest of them, written before the load's record and
    valid with it, so a load that failed is not held to have read its files."""
    out = {"load_id": load_id}
    paths = landing_path
    if only_new:
        files = stored(landing.new_files(spark, landing_path, tb.loaded_files(spark, table_path, load_id)), "landing-files")
        paths = [unquote(r["source_file"]) for r in files.select("source_file").collect()]
        out["files"] = len(paths)
    raw = landing.read_landing(spark, paths) if paths else spark.createDataFrame([], LANDING_DDL)
    staged = shared_dir(spark, "staging", unique=True)
    tagged = cleaning.tag_transfers(cleaning.clean_transfers(raw))
    tagged.write.partitionBy("is_good").parquet(staged)
    rows = spark.read.schema(tagged.schema).parquet(staged)
    cleaning.dlq_rows(rows).write.mode("overwrite").parquet(f"{dlq_path.rstrip('/')}/load_id={load_id}")
    if only_new:
        tb.record_files(files, table_path, load_id)
    return {**out, "good_rows": tb.write_load(cleaning.good_rows(rows), table_path, load_id, operation)}


def stream_stats_job(spark: SparkSession, *, dim_source: DataFrame, snapshot_path: str,
                     lake_path: str, checkpoint: str, serving_path: str | None = None,
                     serving_format: str = "parquet", serving_options: dict | None = None,
                     source: str = "files", source_path: str | None = None,
                     source_options: dict | None = None, max_per_trigger: int | None = None,
                     state_partitions: int | None = None, money_scale: int | None = None,
                     dedupe_key: str | None = None, salt_buckets: int | None = None, audit_path: str | None = None):
    """The streaming job: events -> enrichment from a frozen receiver dimension -> sliding
    stats -> lake log (+ serving sink), drained with availableNow on ``checkpoint``.
    ``dim_source`` is the good-transfer table the dimension is built from, and with
    ``salt_buckets`` the receivers that are frequent in it are salted. ``audit_path``: a second
    stream over the same source writes the accounts of each batch there (``audit_batch``)."""
    from transferlake.operators.enrich import hot_receivers, receiver_dim
    from transferlake.sources.events import decode_events, read_event_stream
    from transferlake.streaming.stats_stream import (audit_batch, dimension_snapshot, run_available,
                                                     sliding_stats_stream, stats_sink)
    dim = dimension_snapshot(receiver_dim(dim_source), snapshot_path)
    records = read_event_stream(spark, source, path=source_path, options=source_options,
                                max_per_trigger=max_per_trigger)
    if audit_path:
        run_available(decode_events(records), f"{checkpoint.rstrip('/')}-audit", audit_batch(audit_path), output_mode="append")
    agg = sliding_stats_stream(records, dim, money_scale=money_scale, dedupe_key=dedupe_key,
                               salt_buckets=salt_buckets, hot=hot_receivers(dim_source) if salt_buckets else None)
    return run_available(agg, checkpoint, stats_sink(lake_path, serving_path, serving_format, serving_options),
                         state_partitions=state_partitions)


def alerts_job(spark: SparkSession, *, out_path: str, checkpoint: str, source: str = "files",
               source_path: str | None = None, source_options: dict | None = None,
               max_per_trigger: int | None = None, threshold: float = LARGE_TRANSFER_THRESHOLD):
    """The alert consumer: large transfers of the stream, appended under ``out_path`` a batch at
    a time (drained with availableNow on ``checkpoint``)."""
    from transferlake.sources.events import read_event_stream
    from transferlake.streaming.sinks import write_batch
    from transferlake.streaming.stats_stream import run_available, stream_alerts
    records = read_event_stream(spark, source, path=source_path, options=source_options, max_per_trigger=max_per_trigger)
    return run_available(stream_alerts(records, threshold), checkpoint,
                         lambda df, batch: write_batch(df, out_path, batch), output_mode="append")


def publish_landing(spark: SparkSession, landing_path: str, *, fmt: str = "text",
                    out_path: str | None = None, options: dict | None = None,
                    cap: int | None = None, on_bad: str = "zero") -> int:
    """The publisher: landing CSV files (columns bound by each file's header) numbered 1..N
    in (file name, position in file) order, optionally capped, written as JSON events to text
    files or a topic. Under a cap only about the first files that hold it are read. Returns the
    number of events published."""
    from pyspark.sql import Observation
    from transferlake.operators.publish import capped_files, publish_events
    from transferlake.sources.events import write_events

    def read(paths):
        return landing.read_landing(spark, paths, by_header=True, with_source=True)

    if cap is not None:
        files = sorted((r["source_file"], r["length"]) for r in landing.landing_files(spark, landing_path).collect())
        landing_path = capped_files(read, [(unquote(f), n) for f, n in files], cap)
    events = publish_events(read(landing_path), cap=cap, on_bad=on_bad)
    obs = Observation("published")
    write_events(events.observe(obs, F.count(F.lit(1)).alias("n")), fmt, path=out_path, options=options)
    return int(obs.get["n"])
