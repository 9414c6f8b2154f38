"""Streaming queries: V4 events replayed in time-ordered chunks through a file-stream source,
each arrival drained by one availableNow run on the same checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transferlake.operators.enrich import hot_receivers
from transferlake.plans.views import MONEY_SCALE, Views, for_oracle
from transferlake.operators.stats import flatten_window
from transferlake.schemas import EVENT_DDL, STATS_KEY
from transferlake.session import shared_dir
from transferlake.sources import testdata
from transferlake.sources.events import decode_events, read_event_stream
from transferlake.streaming import replay as rp
from transferlake.streaming import sinks
from transferlake.streaming.stats_stream import (AUDIT_DDL, audit_batch, dimension_snapshot, run_available,
                                                 sliding_stats_stream, stats_sink, stream_alerts)

FIELDS = [f.strip().split(" ")[0] for f in EVENT_DDL.split(",")]
ARRIVALS = 4                          # of equal spans of event time
SHORT_ARRIVALS = 8
STATS_KEYS = ["window", "status", "currency"]
# Stateful shuffle partitions of the stats stream (the reference runs its stream with 4).
STATE_PARTITIONS = 4
SERVING_KEYS = STATS_KEY
SERVING_DDL = ("window_start TIMESTAMP, window_end TIMESTAMP, status STRING, total_sum DOUBLE, tx_count BIGINT, "
               "currency STRING, batch_id BIGINT")


def run_stats_replay(spark: SparkSession, sf_dir: str, name: str, arrivals: int = ARRIVALS,
                     serving: str | None = None, events: DataFrame | None = None, output_mode: str = "update",
                     order: list[int] | None = None, redeliver: set[int] | None = None,
                     dedupe_key: str | None = None, drains: int = 1, salt_buckets: int | None = None,
                     audit: bool = False, after=None) -> str:
    """Replay V4 and run the stats stream after every chunk; returns the output folder.
    ``audit`` drains a second stream that accounts for late events, and ``after(base, k)`` is
    called when chunk k has been drained."""
    v = Views(spark, sf_dir)
    base = shared_dir(spark, "stream", name, unique=True)
    events = v.events if events is None else events
    dim = dimension_snapshot(v.dim, f"{base}/dim")
    src = f"{base}/src"
    sink = stats_sink(f"{base}/stats", f"{base}/serving" if serving else None, serving or "parquet")
    hot = hot_receivers(v.good) if salt_buckets else None

    def drain(k):
        for _ in range(drains):
            records = read_event_stream(spark, "files", path=src)
            agg = sliding_stats_stream(records, dim, money_scale=MONEY_SCALE, dedupe_key=dedupe_key,
                                       salt_buckets=salt_buckets, hot=hot)
            run_available(agg, f"{base}/checkpoint", sink, output_mode=output_mode,
                          state_partitions=STATE_PARTITIONS)
        if audit:
            run_available(decode_events(read_event_stream(spark, "files", path=src)), f"{base}/audit-checkpoint",
                          audit_batch(f"{base}/audit"), output_mode="append")
        if after:
            after(base, k)

    rp.replay(events, rp.chunk_of(events, arrivals), arrivals, FIELDS, src, drain, order, redeliver)
    return base


def stream_sliding_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = run_stats_replay(spark, sf_dir, "sliding")
    return for_oracle(flatten_window(sinks.read_latest(spark, f"{base}/stats", STATS_KEYS)))


def stats_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: more, shorter chunks (more keys updated in several batches), merged into a base by day
    after half of them and at the end: the second merge rewrites only the days it touches."""
    def merge(base, k):
        if k in (SHORT_ARRIVALS // 2, SHORT_ARRIVALS - 1):
            sinks.merge_batches(spark, f"{base}/stats", STATS_KEYS, f"{base}/base", "window.start")
    base = run_stats_replay(spark, sf_dir, "upsert", SHORT_ARRIVALS, after=merge)
    merged = sinks.read_merged(spark, f"{base}/stats", STATS_KEYS, f"{base}/base")
    return for_oracle(flatten_window(merged))


def stats_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log folded into one row per key."""
    base = run_stats_replay(spark, sf_dir, "compact")
    merged = sinks.compact(spark, f"{base}/stats", STATS_KEYS, f"{base}/merged")
    return for_oracle(flatten_window(merged.drop("batch_id")))


def stream_hot_receiver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the events on one receiver; the receivers that a sketch of the transfers
    finds frequent are salted, the others are joined as they are."""
    events = testdata.with_hot_receiver(Views(spark, sf_dir).events)
    base = run_stats_replay(spark, sf_dir, "hot", arrivals=2, events=events, salt_buckets=8)
    return for_oracle(flatten_window(sinks.read_latest(spark, f"{base}/stats", STATS_KEYS)))


def stream_late_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stream_late_drop with its accounts. Events counted in the windows (each is in ten of
    them), late events and events without a time add up to the events sent."""
    base = run_stats_replay(spark, sf_dir, "late_counts", order=[0, 2, 1, 3], audit=True)
    stats = sinks.read_latest(spark, f"{base}/stats", STATS_KEYS)
    counted = stats.agg((F.sum("tx_count") / 10).cast("bigint").alias("counted"))
    seen = spark.read.schema(AUDIT_DDL).parquet(f"{base}/audit").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("events", "late", "no_event_time")])
    return seen.join(counted)


def stream_dual_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = run_stats_replay(spark, sf_dir, "dual", serving="parquet")
    return for_oracle(sinks.read_latest(spark, f"{base}/serving", SERVING_KEYS))


def stream_sliding_stats_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I4 append mode: each window is emitted once, when the watermark closes it; windows still
    open at the end of the replay are held back."""
    base = run_stats_replay(spark, sf_dir, "append", output_mode="append")
    return for_oracle(flatten_window(spark.read.parquet(f"{base}/stats").drop("batch_id")))


def stream_late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second quarter arrives after the third; by then the watermark is past all of its
    windows, so its events are dropped as late and counted nowhere."""
    base = run_stats_replay(spark, sf_dir, "late", order=[0, 2, 1, 3])
    return for_oracle(flatten_window(sinks.read_latest(spark, f"{base}/stats", STATS_KEYS)))


def stream_redelivery_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 (stream): the second quarter is delivered twice in one arrival; duplicates of a tx_id
    within the watermark delay are dropped, so the result equals the batch result."""
    base = run_stats_replay(spark, sf_dir, "redeliver", redeliver={1}, dedupe_key="tx_id")
    return for_oracle(flatten_window(sinks.read_latest(spark, f"{base}/stats", STATS_KEYS)))


def stream_two_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I2/I3 over two months of events (V4 and a copy 31 days later): equal to the batch result."""
    events = testdata.second_month(Views(spark, sf_dir).events)
    base = run_stats_replay(spark, sf_dir, "months", events=events)
    return for_oracle(flatten_window(sinks.read_latest(spark, f"{base}/stats", STATS_KEYS)))


def stream_serving_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The serving sink in an append-only external format (JSON). Its rows carry the
    batch id, so a reader takes the latest row of each key."""
    base = run_stats_replay(spark, sf_dir, "json", serving="json")
    served = spark.read.schema(SERVING_DDL).json(f"{base}/serving")
    return for_oracle(sinks.latest_per_key(served, SERVING_KEYS))


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every arrival is drained twice; the second run on the same checkpoint finds nothing
    new and counts nothing again."""
    base = run_stats_replay(spark, sf_dir, "restart", arrivals=2, drains=2)
    return for_oracle(flatten_window(sinks.read_latest(spark, f"{base}/stats", STATS_KEYS)))


STREAM_ALERT_THRESHOLD = 200.0


def stream_transfer_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6 as a stream over the replayed events (append mode, batch-partitioned sink)."""
    v = Views(spark, sf_dir)
    base = shared_dir(spark, "stream", "alerts", unique=True)
    src = f"{base}/src"

    def drain(_k):
        alerts = stream_alerts(read_event_stream(spark, "files", path=src), STREAM_ALERT_THRESHOLD)
        run_available(alerts, f"{base}/checkpoint",
                      lambda df, bid: sinks.write_batch(df, f"{base}/out", bid), output_mode="append")

    rp.replay(v.events, rp.chunk_of(v.events, ARRIVALS), ARRIVALS, FIELDS, src, drain)
    # declared schema: a run without any alert still reads back as an empty result
    out = spark.read.schema("tx_id BIGINT, receiver_id STRING, amount DOUBLE, batch_id BIGINT")
    return out.parquet(f"{base}/out").drop("batch_id")


QUERIES = {
    "stream_sliding_stats": stream_sliding_stats,
    "stats_upsert": stats_upsert,
    "stats_compact": stats_compact,
    "stream_hot_receiver": stream_hot_receiver,
    "stream_late_counts": stream_late_counts,
    "stream_dual_sink": stream_dual_sink,
    "stream_sliding_stats_append": stream_sliding_stats_append,
    "stream_late_drop": stream_late_drop,
    "stream_redelivery_dedupe": stream_redelivery_dedupe,
    "stream_two_months": stream_two_months,
    "stream_serving_json": stream_serving_json,
    "stream_restart": stream_restart,
    "stream_transfer_alerts": stream_transfer_alerts,
}
