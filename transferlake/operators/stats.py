"""Sliding event-time statistics (A1, I2) and the serving layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferlake.functions import money
from transferlake.schemas import WINDOW_DURATION, WINDOW_SLIDE


def _micros(interval: str) -> int:
    n, unit = interval.split()
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(n) * scale * 1_000_000


def _total(amount, money_scale):
    total = F.sum(money(amount, money_scale))
    return total.cast("double") if money_scale is not None else total


def sliding_stats(enriched: DataFrame, window: str = WINDOW_DURATION, slide: str = WINDOW_SLIDE,
                  money_scale: int | None = None, strategy: str = "preagg") -> DataFrame:
    """sum(amount) and count(tx_id) per (sliding window, status, currency).

    Output: window_start, window_end, status, currency, total_sum, tx_count. NULL currency is
    a group; count skips NULL ids; rows without event time are dropped (as the window
    operator does).

    ``strategy="window"`` is Spark's own sliding window: every event is expanded into
    window/slide copies before the partial aggregate. ``strategy="preagg"`` first aggregates
    per slide-sized bucket (one copy per event), then expands only the bucket aggregates;
    equal because the slide divides the window. Both aggregate partially map-side, so a hot
    (status, currency) key never lands whole in one task.

    Measured on the sf0.1 events (cached input, median of 5): with about one event per
    (minute, status, currency) "window" is faster (0.67 s vs 0.89 s: pre-aggregation merges
    nothing and adds a stage); at about 10 events per bucket and key they tie; at about 200
    "preagg" is faster (0.25 s vs 0.29 s) and the gap grows with density, since "window"
    updates window/slide hash entries per event. Production event rates are far denser than
    that, so "preagg" is the default."""
    w_us, s_us = _micros(window), _micros(slide)
    if strategy == "window":
        g = (enriched.groupBy(F.window("event_time", window, slide).alias("w"), "status", "currency")
                     .agg(_total("amount", money_scale).alias("total_sum"),
                          F.count("tx_id").alias("tx_count")))
        return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                        "status", "currency", "total_sum", "tx_count")
    if w_us % s_us:
        raise ValueError("preagg needs a slide that divides the window")
    n = w_us // s_us
    micros = F.unix_micros("event_time")
    bucket = (micros - F.pmod(micros, F.lit(s_us))).alias("bucket")
    amount = money("amount", money_scale)
    pre = (enriched.where(F.col("event_time").isNotNull())
                   .groupBy(bucket, "status", "currency")
                   .agg(F.sum(amount).alias("s"), F.count("tx_id").alias("c")))
    expanded = (pre.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
                   .select((F.col("bucket") - F.col("i") * F.lit(s_us)).alias("start_us"),
                           "status", "currency", "s", "c"))
    g = expanded.groupBy("start_us", "status", "currency").agg(F.sum("s").alias("s"),
                                                               F.sum("c").alias("tx_count"))
    total = F.col("s").cast("double") if money_scale is not None else F.col("s")
    return g.select(F.timestamp_micros("start_us").alias("window_start"),
                    F.timestamp_micros(F.col("start_us") + F.lit(w_us)).alias("window_end"),
                    "status", "currency", total.alias("total_sum"), "tx_count")


def nest_window(flat: DataFrame) -> DataFrame:
    """Flat stats to the table shape with ``window STRUCT<start, end>``."""
    return flat.select(F.struct(F.col("window_start").alias("start"),
                                F.col("window_end").alias("end")).alias("window"),
                       "status", "total_sum", "tx_count", "currency")


def flatten_window(nested: DataFrame) -> DataFrame:
    return nested.select(F.col("window.start").alias("window_start"),
                         F.col("window.end").alias("window_end"),
                         "status", "total_sum", "tx_count", "currency")


def serving_layout(flat: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Serving order (window_start, status): range-partitioned, sorted inside each partition,
    so files cover disjoint time ranges and readers can skip by min/max statistics."""
    keys = ["window_start", "status"]
    ranged = (flat.repartitionByRange(num_partitions, *keys) if num_partitions
              else flat.repartitionByRange(*keys))
    return ranged.sortWithinPartitions(*keys)
