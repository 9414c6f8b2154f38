"""Streaming sliding statistics.

topic/file records -> JSON decode -> receiver dimension lookup (stream-static left join)
-> 15-minute watermark -> 10-minute windows sliding by 1 minute -> sum/count per
(window, status, currency) -> update-mode foreachBatch into replay-safe sinks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transferlake.functions import lenient_amount, money
from transferlake.operators.enrich import enrich_events, snapshot_dimension, with_event_time
from transferlake.operators.stats import flatten_window
from transferlake.session import read_optional
from transferlake.schemas import (EVENT_DDL, WATERMARK_DELAY, WINDOW_DURATION, WINDOW_SLIDE)
from transferlake.sources.events import decode_events
from transferlake.streaming.sinks import DualSink, write_batch

STATE_STORE_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def dimension_snapshot(dim: DataFrame, path: str) -> DataFrame:
    """Freeze the static side for the stream: a fixed snapshot, written once, in a folder of its
    own under ``path`` (a running stream may still read an earlier one)."""
    return snapshot_dimension(dim, f"{path.rstrip('/')}/{uuid.uuid4().hex[:12]}")


def sliding_stats_stream(records: DataFrame, dim: DataFrame, watermark: str = WATERMARK_DELAY, window: str = WINDOW_DURATION,
                         slide: str = WINDOW_SLIDE, money_scale: int | None = None,
                         observe_name: str | None = None, salt_buckets: int | None = None,
                         dedupe_key: str | None = None, hot: list[str] | None = None) -> DataFrame:
    """Streaming aggregate with the table shape (window struct, status, total_sum, tx_count,
    currency). Rows without event time never reach a window; ``observe_name`` counts them.
    Catalyst broadcasts the dimension if its files are below the session's threshold;
    ``salt_buckets`` spreads the ``hot`` receivers over so many join tasks where it is larger (no
    AQE skew handling runs in a stream). ``dedupe_key`` drops redelivered events (same key within the
    watermark delay) before they are counted, as at-least-once sources redeliver."""
    events = with_event_time(decode_events(records, EVENT_DDL))
    if observe_name:
        events = events.observe(observe_name, F.count(F.lit(1)).alias("rows"),
                                F.count(F.when(F.col("event_time").isNull(), 1)).alias("no_event_time"))
    enriched = enrich_events(events, dim, salt_buckets=salt_buckets, hot=hot)
    total = F.sum(money("amount", money_scale))
    if money_scale is not None:
        total = total.cast("double")
    timed = enriched.withWatermark("event_time", watermark)
    if dedupe_key:
        # Events without the key are duplicates only if they agree in everything.
        same = F.when(F.col(dedupe_key).isNull(), F.xxhash64(*timed.columns))
        timed = timed.withColumn("_same", same).dropDuplicatesWithinWatermark([dedupe_key, "_same"])
    return (timed
                    .groupBy(F.window("event_time", window, slide), "status", "currency")
                    .agg(total.alias("total_sum"), F.count("tx_id").alias("tx_count"))
                    .select("window", "status", "total_sum", "tx_count", "currency"))


def run_available(agg: DataFrame, checkpoint: str, sink, output_mode: str = "update",
                  query_name: str | None = None, state_partitions: int | None = None,
                  idle_batches: bool = True):
    """Drain everything available, then stop (trigger availableNow); restart-safe through
    the checkpoint.

    ``state_partitions``: shuffle partitions of the stateful aggregate, fixed by the
    checkpoint at its first run (later values are ignored by Spark). ``idle_batches``: the
    no-data batch after the data evicts state, emits the windows closed in append mode, and
    records the advanced watermark in the checkpoint; without it the next availableNow run
    starts one watermark behind and would admit rows that are already late. Keep it on
    unless no run follows."""
    spark = agg.sparkSession
    conf = {"spark.sql.streaming.noDataMicroBatches.enabled": str(idle_batches).lower()}
    if state_partitions:
        conf["spark.sql.shuffle.partitions"] = str(state_partitions)
    saved = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        w = (agg.writeStream.foreachBatch(sink).outputMode(output_mode)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True))
        if query_name:
            w = w.queryName(query_name)
        q = w.start()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    q.awaitTermination()
    return q


def last_window_end(event_time, window_minutes: int = 10, slide_minutes: int = 1):
    """End of the last sliding window that holds a time: at or before the watermark, the event is
    counted in no window."""
    slide = slide_minutes * 60
    return F.timestamp_seconds(F.floor(F.unix_timestamp(event_time) / slide) * slide + window_minutes * 60)


def audit_batch(out_path: str, watermark_minutes: int = 15):
    """foreachBatch function over ``decode_events`` records of the topic that accounts for
    every event of a batch: batch_id, events, no_event_time, late (all of its windows ended at or
    before the watermark, which is the latest event time of the batches before less the delay)
    and last_event_time. A batch run again replaces its row. Spark's own metric counts rows after
    partial aggregation and not events."""
    def run(events: DataFrame, batch_id: int) -> None:
        spark = events.sparkSession
        before = read_optional(spark, out_path, AUDIT_DDL).where(F.col("batch_id") < batch_id)
        mark = before.agg(F.max("last_event_time") - F.expr(f"INTERVAL {watermark_minutes} MINUTE")).first()[0]
        timed = with_event_time(events)
        late = F.lit(False) if mark is None else last_window_end(F.col("event_time")) <= F.lit(mark)
        row = timed.agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col("event_time").isNull()).alias("no_event_time"),
                        F.count_if(late).alias("late"), F.max("event_time").alias("last_event_time"))
        write_batch(row, out_path, batch_id)
    return run


AUDIT_DDL = "events bigint, no_event_time bigint, late bigint, last_event_time timestamp, batch_id bigint"


def progress_rows(query) -> list[dict]:
    """What Spark reports of each batch of a run: batch_id, input rows, watermark and the rows
    (partial sums per window, not events) that its state dropped as late."""
    return [{"batch_id": p["batchId"], "input_rows": p["numInputRows"], "watermark": (p.get("eventTime") or {}).get("watermark"),
             "late_window_rows": sum(o.get("numRowsDroppedByWatermark", 0) for o in p["stateOperators"])} for p in query.recentProgress]


def stats_sink(lake_path: str, serving_path: str | None = None, serving_format: str = "parquet",
               serving_options: dict | None = None) -> DualSink:
    return DualSink(lake_path, serving_path, serving_format, serving_options, flatten=flatten_window)


ALERT_DDL = EVENT_DDL.replace("amount DOUBLE", "amount STRING")


def stream_alerts(records: DataFrame, threshold: float) -> DataFrame:
    """D6 on a stream: events whose amount exceeds the threshold (stateless, append).

    The amount is read as text and parsed leniently (decimal comma, blanks, quotes), as the
    alert consumer does: a JSON number or a string such as "60000,5" both count; a missing
    or unparsable amount raises no alert; undecodable messages are skipped."""
    ev = decode_events(records, ALERT_DDL).withColumn("amount", lenient_amount("amount", None))
    return ev.where(F.col("amount") > threshold).select("tx_id", "receiver_id", "amount")


def use_rocksdb(spark: SparkSession) -> None:
    """RocksDB state store (set before the first run of a checkpoint)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE_ROCKSDB)
