"""Replay-safe sinks for update-mode streams.

An update-mode stream emits, per micro-batch, the current aggregate of every key the batch
touched. Each batch is written to its own ``batch_id`` partition with dynamic partition
overwrite, so a retried batch replaces its own output instead of duplicating it, and two
sinks fed from one batch are each idempotent per (sink, batch_id). Reading takes the latest
row per key (merge on read); ``merge_batches`` puts new batches into a base by day, rewriting the
days they touch, and ``compact`` folds the whole log into one row per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transferlake.session import read_optional, stored


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    (df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("batch_id").parquet(path))


def latest_per_key(log: DataFrame, keys: list[str], order_col: str = "batch_id") -> DataFrame:
    """Latest version of each key; ``max_by`` aggregates partially before the shuffle."""
    rest = [c for c in log.columns if c not in keys and c != order_col]
    return (log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order_col)).alias("_v"))
               .select(*keys, "_v.*"))


def _log(spark: SparkSession, path: str, base_path: str | None) -> DataFrame:
    log = spark.read.parquet(path)
    if not base_path:
        return log
    base = spark.read.parquet(base_path)
    upto = base.agg(F.max("batch_id")).first()[0]
    return log.where(F.col("batch_id") > (-1 if upto is None else upto)).unionByName(base)


def read_latest(spark: SparkSession, path: str, keys: list[str], base_path: str | None = None) -> DataFrame:
    """Latest row per key of the log; with a base (see ``compact``) only batches newer than
    the base are read from the log."""
    return latest_per_key(_log(spark, path, base_path), keys)


def _folded(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The row of the latest batch of each key, with its batch id."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("batch_id")).alias("_v")).select(*keys, "_v.*")


def compact(spark: SparkSession, path: str, keys: list[str], out_path: str, base_path: str | None = None) -> DataFrame:
    """Fold the log (on top of an earlier base, if given) into a base of one row per key, with
    the batch id the row is from; later reads take the base and the batches after it."""
    _folded(_log(spark, path, base_path), keys).write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)


def _merged_upto(spark: SparkSession, base_path: str) -> int:
    """The last batch that a merge has put into the base (-1 before the first)."""
    marks = read_optional(spark, f"{base_path.rstrip('/')}/_merged", "upto bigint")
    upto = marks.agg(F.max("upto")).first()[0]
    return -1 if upto is None else upto


def _base(spark: SparkSession, base_path: str, like: DataFrame) -> DataFrame:
    schema = like.withColumn("_day", F.lit(0).cast("bigint")).schema
    return read_optional(spark, f"{base_path.rstrip('/')}/rows", schema)


def day_number(time: Column) -> Column:
    """Days since the epoch, whatever the session's time zone."""
    return F.floor(F.unix_timestamp(time) / 86_400).cast("bigint")


def merge_batches(spark: SparkSession, path: str, keys: list[str], base_path: str, time: str) -> int:
    """T5: put the batches since the last merge into a base of one row per key, partitioned by
    the day of ``time`` (a column of the key). Copy on write: only days that the new batches touch
    are rewritten, the files of all others stay as they are. Returns the number of those days.

    The new rows of a day are complete in the shared folder before its partition is replaced, and
    the mark of what is merged comes last: a merge that failed is made again, with the same
    result (the row of the latest batch wins)."""
    log = spark.read.parquet(path)
    log = log.where(F.col("batch_id") > _merged_upto(spark, base_path))
    last = log.agg(F.max("batch_id")).first()[0]
    if last is None:
        return 0
    new = stored(_folded(log, keys).withColumn("_day", day_number(F.col(time))), "merge-new")
    days = stored(new.select("_day").distinct(), "merge-days")
    held = _base(spark, base_path, log).join(days, "_day", "left_semi")
    merged = stored(_folded(held.unionByName(new), [*keys, "_day"]), "merge-days-new")
    (merged.hint("rebalance", "_day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("_day").parquet(f"{base_path.rstrip('/')}/rows"))
    _mark_merged(spark, base_path, last)
    return days.count()


def _mark_merged(spark: SparkSession, base_path: str, upto: int) -> None:
    spark.createDataFrame([(upto,)], "upto bigint").coalesce(1).write.mode("append").parquet(f"{base_path.rstrip('/')}/_merged")


def read_merged(spark: SparkSession, path: str, keys: list[str], base_path: str) -> DataFrame:
    """Latest row per key: the merged base and the batches after it."""
    log = spark.read.parquet(path)
    later = log.where(F.col("batch_id") > _merged_upto(spark, base_path))
    return latest_per_key(_base(spark, base_path, log).drop("_day").unionByName(later), keys)


class DualSink:
    """foreachBatch function writing each batch to a lake log and a serving sink.

    The lake write executes the batch once (running the stateful plan, which every batch must
    do) and counts its rows with an observation; an empty batch (a final no-data batch is
    delivered) writes nothing there and is then skipped for the serving side, so the guard
    costs no extra job. With a serving sink the batch is persisted, so both writes share one
    computation. ``serving_format`` 'parquet' writes a batch-partitioned log like the lake
    side; other formats (e.g. 'jdbc', 'json') append with caller options. Appended rows carry
    ``batch_id``: a key touched by several batches has several rows, and the reader takes the
    one of the latest batch (``latest_per_key``)."""

    def __init__(self, lake_path: str, serving_path: str | None = None,
                 serving_format: str = "parquet", serving_options: dict | None = None,
                 flatten=None):
        self.lake_path, self.serving_path = lake_path, serving_path
        self.serving_format, self.serving_options = serving_format, serving_options or {}
        self.flatten = flatten

    @property
    def has_serving(self) -> bool:
        return self.serving_path is not None or self.serving_format != "parquet"

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        from pyspark.sql import Observation
        if self.has_serving:
            batch_df = batch_df.persist()
        try:
            obs = Observation(f"batch_rows_{batch_id}")
            write_batch(batch_df.observe(obs, F.count(F.lit(1)).alias("n")), self.lake_path, batch_id)
            if not self.has_serving or int(obs.get["n"]) == 0:
                return
            served = self.flatten(batch_df) if self.flatten else batch_df
            if self.serving_format == "parquet":
                write_batch(served, self.serving_path, batch_id)
            else:
                w = (served.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write
                           .format(self.serving_format).mode("append").options(**self.serving_options))
                w.save(self.serving_path) if self.serving_path else w.save()
        finally:
            if self.has_serving:
                batch_df.unpersist()
