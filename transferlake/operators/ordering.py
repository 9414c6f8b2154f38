"""Order-dependent operators that stay distributed.

Rows of a scan are numbered in place: a small table has each split's row count, prefix sums of
it give every split its first number. Rows of any other order are range-partitioned on the full
sort key and frozen as a table in the shared folder, so the second pass sees the partitions the
first one made even if executors are lost. LAG is a plain window, but for groups of more than
``hot_rows`` rows: those alone are range-partitioned on (group, order) and lagged inside (group,
range), and what crosses ranges is one row per (group, range).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from transferlake.session import stored, stored_counted

HOT_ROWS = 10_000_000       # of one group; a window task sorts about as many at most
BROADCAST_SPLITS = 1_000_000

def running_number(df: DataFrame, order_by: list[str], out: str = "seq_id",
                   num_partitions: int | None = None) -> DataFrame:
    """Dense 1..N numbering in ``order_by`` order without a single-task global window.

    number = rows in earlier range partitions + position inside the partition."""
    ranged = df.repartitionByRange(num_partitions, *order_by) if num_partitions else df.repartitionByRange(*order_by)
    ranged = stored(ranged.sortWithinPartitions(*order_by)
                          .withColumn("_pid", F.spark_partition_id())
                          .withColumn("_mid", F.monotonically_increasing_id()), "numbered")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_m0"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", "_m0", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # One row per partition: bounded by the partition count.
    numbered = ranged.join(F.broadcast(offsets), "_pid")
    seq = (F.col("_off") + (F.col("_mid") - F.col("_m0")) + F.lit(1)).cast("bigint")
    return numbered.select(seq.alias(out), *df.columns)


def split_offsets(df: DataFrame, split: list[str], row: str) -> tuple[DataFrame, int]:
    """One row per split of a scan: ``split`` columns (in scan order), its first row id, its
    number of rows and the rows of the splits before it; and the number of splits. Stored; ``row``
    is a row id that rises by one inside a split, such as ``monotonically_increasing_id`` above
    the scan."""
    counts = df.groupBy(*split).agg(F.min(row).alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    return stored_counted(counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))), "splits")


def number_in_place(df: DataFrame, split: list[str], row: str, out: str,
                    offsets: tuple[DataFrame, int] | None = None, cap: int | None = None) -> DataFrame:
    """Dense 1..N numbering in scan order: rows before the row's split, plus its place in the
    split. Event rows are neither sorted nor shuffled: the table of splits is broadcast, up to
    ``BROADCAST_SPLITS`` of them. ``cap`` keeps the numbers up to it. A second scan that is not
    cut as the first was (a cluster that changed size between the two) fails with an error
    rather than number rows wrongly; run again. Columns ``split`` and ``row`` are dropped."""
    offsets, splits = offsets or split_offsets(df, split, row)
    if cap is not None:
        offsets = offsets.where(F.col("_before") < cap)
    names = [f"_s{i}" for i in range(len(split))]
    table = offsets.select(*[F.col(c).alias(n) for c, n in zip(split, names)], "_first", "_n", "_before")
    if splits <= BROADCAST_SPLITS:
        table = F.broadcast(table)
    same = [df[c] == F.col(n) for c, n in zip(split, names)]
    place = F.col(row) - F.col("_first")
    fits = (place >= 0) & (place < F.col("_n"))
    number = F.when(fits, F.col("_before") + place + 1).otherwise(F.raise_error(F.lit("the files were split anew between two scans: run again")).cast("bigint"))
    # Under a cap, rows of splits beyond it have no offset and go; without one, none may.
    joined = df.join(table, same, "inner" if cap is not None else "left")
    numbered = joined.select(number.alias(out), *[c for c in df.columns if c not in (*split, row)])
    return numbered if cap is None else numbered.where(F.col(out) <= cap)


def lag_in_group(df: DataFrame, group: str, order_by: list[str], value: str, out: str,
                 hot_rows: int = HOT_ROWS) -> DataFrame:
    """LAG(value) OVER (PARTITION BY group ORDER BY order_by); NULL is a group like any other.

    The rows are written once. Groups of more than ``hot_rows`` rows (at most rows / hot_rows of
    them; none, if there are no more rows than that) are cut into ranges of about that many; the
    first row of a range takes the last value of the group's range before it."""
    rows, n = stored_counted(df, "lag")
    whole = F.lag(value).over(Window.partitionBy(group).orderBy(*order_by)).alias(out)
    if n <= hot_rows:
        return rows.select("*", whole)
    counts = rows.groupBy(F.col(group).alias("_large")).agg(F.count(F.lit(1)).alias("_n"))
    large = stored(counts.where(F.col("_n") > hot_rows), "lag-groups")
    total = large.agg(F.sum("_n")).first()[0]
    if not total:
        return rows.select("*", whole)
    is_large = rows[group].eqNullSafe(large["_large"])
    others = rows.join(large, is_large, "left_anti").select("*", whole)
    hot = rows.join(large, is_large, "left_semi").repartitionByRange(-(-total // hot_rows) + 1, group, *order_by)
    hot = stored(hot.withColumn("_p", F.spark_partition_id()), "lag-ranges")
    inside = Window.partitionBy(group, "_p").orderBy(*order_by)
    local = hot.withColumn("_lag", F.lag(value).over(inside)).withColumn("_at", F.row_number().over(inside))
    tails = hot.groupBy(group, "_p").agg(F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order_by)).alias("_tail"))
    previous = tails.select(F.col(group).alias("_group"), F.col("_p").alias("_range"),
                            F.lag("_tail").over(Window.partitionBy(group).orderBy("_p")).alias("_prev"))
    previous = stored(previous, "lag-tails")
    joined = local.join(previous, local[group].eqNullSafe(previous["_group"]) & (local["_p"] == previous["_range"]))
    return others.unionByName(joined.select(*rows.columns, F.when(F.col("_at") == 1, F.col("_prev.v")).otherwise(F.col("_lag")).alias(out)))


def prev_amount_by_sender(good: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Previous amount of the same sender by (timestamp, tx_id)."""
    base = good.select("sender_id", "tx_id", "timestamp", "amount")
    return lag_in_group(base, "sender_id", ["timestamp", "tx_id"], "amount", "prev_tx_amount", hot_rows)
