"""Receiver dimension and event enrichment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferlake.functions import epoch_to_instant, normalise_id


def receiver_dim(good: DataFrame) -> DataFrame:
    """One row per receiver: the currency of its earliest transfer by (timestamp, tx_id).
    Good rows carry normalised ids already (the cleaning step strips all whitespace).

    ``min_by`` aggregates partially before the shuffle, so a receiver that owns a third of
    all transfers still spreads over every map task."""
    return (good.groupBy("receiver_id")
                .agg(F.min_by("currency", F.struct("timestamp", "tx_id")).alias("currency")))


def snapshot_dimension(dim: DataFrame, path: str) -> DataFrame:
    """Freeze the dimension as a Parquet table in the shared folder and read it back.

    The join then sees a plain scan: Catalyst decides the broadcast from the table's real file
    size, and beyond that size both join sides are ordinary shuffle stages, which AQE can split
    when one receiver holds a large share of the events (it cannot split a join whose other
    side is an aggregate). A fixed snapshot is also what a stream joins against."""
    dim.write.mode("overwrite").parquet(path)
    return dim.sparkSession.read.parquet(path)


def hot_receivers(transfers: DataFrame, share: float = 0.01) -> list[str]:
    """Receivers that may hold ``share`` of the rows or more: a frequent-items sketch, so every
    such receiver is listed (and perhaps a few others), at most 1 / share of them."""
    if not 0.0001 <= share < 1:
        raise ValueError("share: 0.0001 up to 1")
    found = transfers.select(normalise_id("receiver_id").alias("receiver_id")).where("receiver_id IS NOT NULL")
    return sorted(found.stat.freqItems(["receiver_id"], share).first()[0] or [])


def with_event_time(events: DataFrame) -> DataFrame:
    return events.withColumn("event_time", epoch_to_instant("timestamp"))


def enrich_events(events: DataFrame, dim: DataFrame, broadcast_dim: bool | None = None,
                  salt_buckets: int | None = None, salt_by: str = "tx_id", hot: list[str] | None = None) -> DataFrame:
    """Left join events to the receiver dimension; the event's own currency wins, else the
    dimension's. Unmatched receivers keep a NULL currency (a group of its own downstream).

    ``broadcast_dim``: True when the caller has checked the dimension's size (streams, where
    no adaptive re-planning happens); None leaves the choice to the optimizer and AQE, which
    broadcast only below the measured size threshold and otherwise sort-merge with skew
    splitting on the event side.

    ``salt_buckets``: for a dimension too large to broadcast where no AQE runs (streams), a
    hot receiver is spread over ``salt_buckets`` join tasks: its events get a deterministic salt
    (hash of ``salt_by``, stable across retries) and its dimension row is repeated once per salt
    value. ``hot`` names those receivers (``hot_receivers``, a list of bounded length), so the
    dimension grows by so many rows only; without it all receivers are salted."""
    d = dim.select(F.col("receiver_id").alias("_dim_receiver"), F.col("currency").alias("_dim_currency"))
    if broadcast_dim:
        d = F.broadcast(d)
    ev = events.withColumn("receiver_id", normalise_id("receiver_id"))
    if salt_buckets and not broadcast_dim:
        spread = F.lit(0).cast("bigint")
        is_hot = lambda c: F.lit(True) if hot is None else c.isin(hot) if hot else F.lit(False)
        ev = ev.withColumn("_salt", F.when(is_hot(F.col("receiver_id")), F.pmod(F.xxhash64(F.col(salt_by)), F.lit(salt_buckets))).otherwise(spread))
        salts = F.when(is_hot(F.col("_dim_receiver")), F.sequence(spread, F.lit(salt_buckets - 1).cast("bigint"))).otherwise(F.array(spread))
        d = d.withColumn("_salt", F.explode(salts))
        cond = (ev["receiver_id"] == d["_dim_receiver"]) & (ev["_salt"] == d["_salt"])
        joined = ev.join(d, cond, "left").drop(ev["_salt"]).drop(d["_salt"])
    else:
        joined = ev.join(d, ev["receiver_id"] == d["_dim_receiver"], "left")
    out = joined.withColumn("currency", F.coalesce(F.col("currency"), F.col("_dim_currency")))
    out = out.drop("_dim_receiver", "_dim_currency")
    if "event_time" not in out.columns:
        out = with_event_time(out)
    return out
