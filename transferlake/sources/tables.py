"""Lake tables on plain Parquet.

A table is a folder with
  data/load_id=N/   the rows of load N, partitioned by status
  _loads/           one small record per load: load_id, operation, committed_at, n_rows, target
  _files/           landing files that loads have read (see ``loaded_files``)
  _compactions/     compactions begun and ended (see ``compact_files``)
A load's record is written after its data, and rows without a record are not read. A ``replace``
load hides every earlier one, ``append`` adds to what is visible, and a ``rollback`` has no rows
of its own: its record points at the load whose state it brings back. A rerun of a load replaces
its rows; until it has ended the load is incomplete, as with any Parquet folder that is
overwritten.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferlake.schemas import GOOD_COLUMNS
from transferlake.session import read_optional, shared_dir, stored

LOAD_SCHEMA = T.StructType([
    T.StructField("load_id", T.LongType()),
    T.StructField("operation", T.StringType()),
    T.StructField("committed_at", T.TimestampType()),
    T.StructField("n_rows", T.LongType()),
    T.StructField("target", T.LongType()),
])

_LOADS_DDL = "load_id bigint"

# Types of the data folder: partition values keep them whatever their folder names look like.
DATA_SCHEMA = T.StructType([
    T.StructField("tx_id", T.StringType()),
    T.StructField("sender_id", T.StringType()),
    T.StructField("receiver_id", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("currency", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("load_id", T.LongType()),
    T.StructField("status", T.StringType()),
])


def _data(path: str) -> str:
    return f"{path.rstrip('/')}/data"


def _loads(path: str) -> str:
    return f"{path.rstrip('/')}/_loads"


def _read_data(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DATA_SCHEMA).parquet(_data(path))


def _record_loads(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, LOAD_SCHEMA).coalesce(1).write.mode("append").parquet(_loads(path))


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def bytes_per_row(spark: SparkSession, path: str) -> float | None:
    """Bytes of file a row of the table takes, learned from the files there are."""
    n = read_optional(spark, _loads(path), LOAD_SCHEMA).where("operation <> 'rollback'").agg(F.sum("n_rows")).first()[0]
    size = data_files(spark, path).agg(F.sum("length")).first()[0] if n else None
    return size / n if size else None


def _sized(df: DataFrame, row_bytes: float, target_bytes: int) -> DataFrame:
    """Rows dealt by status into as many tasks as make files of about ``target_bytes``."""
    counts = df.groupBy("status").agg(F.count(F.lit(1)).alias("_n"))
    files = stored(counts.select(F.col("status").alias("_status"), F.greatest(F.lit(1), F.round(F.col("_n") * row_bytes / target_bytes)).cast("bigint").alias("_files")), "load-files")
    total = files.agg(F.sum("_files")).first()[0] or 1
    dealt = df.join(files, df["status"].eqNullSafe(files["_status"])).withColumn("_file", F.pmod(F.xxhash64("tx_id", "timestamp", "amount"), F.col("_files")))
    return dealt.repartition(int(total), "status", "_file").sortWithinPartitions("status", "_file").select(*GOOD_COLUMNS)


def write_load(df: DataFrame, path: str, load_id: int, operation: str = "append",
               target_bytes: int | None = None) -> int:
    """Write one load, perhaps of no rows. ``operation``: 'replace' (S6: create-or-replace) or
    'append' (S7). Rows are rebalanced by status (AQE splits a hot status
    into pieces of the session's advisory size and merges small ones) and counted from the
    written files. Returns the count.

    ``target_bytes`` (T4, 128 MiB in the reference's table) makes files of about that size: the
    bytes a row takes are learned from the table's files and turned into a number of files for
    each status. It counts the rows first, so ``df`` should be a table; the first load has
    nothing to learn from and is rebalanced."""
    if operation not in ("replace", "append"):
        raise ValueError(operation)
    spark, folder = df.sparkSession, f"{_data(path)}/load_id={load_id}"
    rows = df.select(*GOOD_COLUMNS)
    row_bytes = bytes_per_row(spark, path) if target_bytes else None
    rows = _sized(rows, row_bytes, target_bytes) if row_bytes else rows.hint("rebalance", "status")
    # Two files' rows may fall to one task, which then starts a second file.
    most = max(1, round(1.1 * target_bytes / row_bytes)) if row_bytes else 0
    rows.write.mode("overwrite").option("maxRecordsPerFile", most).partitionBy("status").parquet(folder)
    n = spark.read.schema(DATA_SCHEMA).parquet(folder).count()
    _record_loads(spark, path, [(load_id, operation, _now(), n, None)])
    return n


def write_loads(df: DataFrame, path: str, load_col, operation_of) -> None:
    """Backfill many loads in one job: ``load_col`` gives each row its load id and
    ``operation_of(load_id, first_load_id) -> str`` its operation. Row counts come from the
    written files, not from a second pass over the input."""
    spark = df.sparkSession
    load = F.col(load_col) if isinstance(load_col, str) else load_col
    out = df.select(*GOOD_COLUMNS).withColumn("load_id", load.cast("bigint"))
    (out.hint("rebalance", "load_id", "status").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("load_id", "status").parquet(_data(path)))
    counts = {int(r["load_id"]): int(r["count"]) for r in _read_data(spark, path).groupBy("load_id").count().collect()}
    now = _now()
    if counts:
        _record_loads(spark, path, [(k, operation_of(k, min(counts)), now, n, None) for k, n in sorted(counts.items())])


def rollback(spark: SparkSession, path: str, to_load: int) -> int:
    """Make the state as of ``to_load`` current again, as a new load (operation 'rollback',
    target = to_load) that hides what came after. A record is all that is written."""
    known = loads(spark, path).agg(F.max("load_id").alias("last"), F.max(F.col("load_id") == to_load).alias("known")).first()
    if not known["known"]:
        raise ValueError(f"no load {to_load}")
    new_id = known["last"] + 1
    n = loads(spark, path).join(visible_loads(spark, path, to_load), "load_id", "left_semi").agg(F.sum("n_rows")).first()[0]
    _record_loads(spark, path, [(new_id, "rollback", _now(), n or 0, to_load)])
    return new_id


def loads(spark: SparkSession, path: str) -> DataFrame:
    """The last record of every load."""
    rest = [f.name for f in LOAD_SCHEMA if f.name != "load_id"]
    records = spark.read.schema(LOAD_SCHEMA).parquet(_loads(path))
    return records.groupBy("load_id").agg(F.max_by(F.struct(*rest), "committed_at").alias("_r")).select("load_id", "_r.*")


def load_history(spark: SparkSession, path: str, n: int | None = 5) -> DataFrame:
    """Newest loads first, by commit time (loads of one commit by id)."""
    h = loads(spark, path).orderBy(F.desc("committed_at"), F.desc("load_id"))
    return h.limit(n) if n else h


def visible_loads(spark: SparkSession, path: str, as_of: int | None = None) -> DataFrame:
    """load_id of the loads that make up the table state as of a load (latest when None).

    The state is a chain of load intervals: back from ``as_of`` to the last load that is no
    append; if that is a rollback, on from its target, and so on until a replace or the first
    load. A small read of the load records for each rollback of the chain."""
    h = loads(spark, path)
    seen, at = F.lit(False), as_of
    while True:
        upto = F.lit(True) if at is None else F.col("load_id") <= at
        mark = h.where(upto & (F.col("operation") != "append")).orderBy(F.desc("load_id")).first()
        seen = seen | (upto & (F.lit(True) if mark is None else F.col("load_id") >= mark["load_id"]))
        if mark is None or mark["operation"] != "rollback":
            return h.where(seen & (F.col("operation") != "rollback")).select("load_id")
        at = mark["target"]


def _state(spark: SparkSession, path: str, as_of: int | None = None) -> DataFrame:
    """Rows of the visible loads: a semi join on the partition column, pruned at run time."""
    return _read_data(spark, path).join(visible_loads(spark, path, as_of), "load_id", "left_semi")


def read_table(spark: SparkSession, path: str, as_of: int | None = None,
               with_load: bool = False) -> DataFrame:
    """Table state (T9 as-of when ``as_of`` is given)."""
    return _state(spark, path, as_of).select(*GOOD_COLUMNS, *(["load_id"] if with_load else []))


def table_files(spark: SparkSession, path: str, as_of: int | None = None) -> DataFrame:
    """Data files of the table state (current, or as of a load): file_path,
    record_count, file_size_in_bytes, partition."""
    files = _read_data(spark, path).select(
        "load_id", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size_in_bytes"),
        F.struct("load_id", "status").alias("partition"))
    return (files.join(visible_loads(spark, path, as_of), "load_id", "left_semi")
                 .groupBy("file_path", "file_size_in_bytes", "partition")
                 .agg(F.count(F.lit(1)).alias("record_count")))


def partition_summary(spark: SparkSession, path: str, as_of: int | None = None) -> DataFrame:
    """T7 per partition: number of data files and rows in each (load_id, status) of the state."""
    files = table_files(spark, path, as_of)
    return (files.groupBy(F.col("partition.load_id").alias("load_id"), F.col("partition.status").alias("status"))
                 .agg(F.count(F.lit(1)).alias("n_files"), F.sum("record_count").alias("record_count")))


TARGET_FILE_BYTES = 128 << 20
_COMPACTION = "compaction string, staged string, at timestamp, done boolean"


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """load_id, status, file, length of every data file, from the folder listing alone."""
    listing = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY, load_id BIGINT, status STRING"
    files = spark.read.schema(listing).format("binaryFile").load(_data(path))
    return files.select("load_id", "status", F.col("_metadata.file_path").alias("file"), "length").coalesce(64)


def small_file_bins(files: DataFrame, target_bytes: int) -> DataFrame:
    """load_id, status, file, bin: files of the partitions that bin packing leaves with fewer
    files than they have, in bins of about the target size (next fit, by file name)."""
    part = Window.partitionBy("load_id", "status")
    before = F.coalesce(F.sum("length").over(part.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    binned = files.withColumn("bin", F.floor(before / target_bytes))
    bins = binned.groupBy("load_id", "status").agg(F.count(F.lit(1)).alias("_files"), F.countDistinct("bin").alias("_bins")).where("_files > _bins")
    return binned.join(bins, (binned["load_id"] == bins["load_id"]) & binned["status"].eqNullSafe(bins["status"]), "left_semi").select("load_id", "status", "file", "bin")


def compact_files(spark: SparkSession, path: str, load_ids: list[int] | None = None,
                  target_bytes: int = TARGET_FILE_BYTES) -> int:
    """Pack the small files of the given loads (all when None) into files of about
    ``target_bytes``; rows and load records are unchanged. Returns the number of partitions
    rewritten: those where packing leaves fewer files; others are not touched.

    The packed rows are first written to the shared folder and counted against the data, then
    recorded, and only then put in place by a dynamic overwrite of their partitions. A
    compaction that was recorded but not ended (a failure while it was put in place) is put in
    place again, whole, by the next call: no rows are ever in one place only. Readers may see a
    partition missing while it is replaced, as with any Parquet folder."""
    finish_compactions(spark, path)
    files = data_files(spark, path)
    if load_ids is not None:
        files = files.where(F.col("load_id").isin(load_ids))
    bins = stored(small_file_bins(files, target_bytes), "compaction-bins")
    n = bins.select("load_id", "status").distinct().count()
    if not n:
        return 0
    rows = _read_data(spark, path).withColumn("_file", F.col("_metadata.file_path"))
    wanted = bins.select(F.col("load_id").alias("_load"), F.col("file").alias("_name"), F.col("bin").alias("_bin"))
    packed = rows.join(wanted, (rows["load_id"] == wanted["_load"]) & (rows["_file"] == wanted["_name"])).select(*GOOD_COLUMNS, "load_id", "_bin")
    staged = shared_dir(spark, "compaction", unique=True)
    packed.repartition("load_id", "status", "_bin").write.partitionBy("load_id", "status", "_bin").parquet(staged)
    key = ["load_id", "status"]
    had = _read_data(spark, path).join(bins.select(*key).distinct(), key, "left_semi").groupBy(*key).count()
    have = _read_staged(spark, staged).groupBy(*key).count()
    if had.exceptAll(have).unionByName(have.exceptAll(had)).count():
        raise RuntimeError(f"{path}: the table changed while it was compacted; nothing was replaced")
    name = staged.rsplit("/", 1)[-1]
    _record_compaction(spark, path, name, staged, False)
    _put_in_place(spark, path, staged)
    _record_compaction(spark, path, name, staged, True)
    return n


def _read_staged(spark: SparkSession, staged: str) -> DataFrame:
    return spark.read.schema(T.StructType([*DATA_SCHEMA.fields, T.StructField("_bin", T.LongType())])).parquet(staged)


def _put_in_place(spark: SparkSession, path: str, staged: str) -> None:
    """Staged partitions replace the table's, one file a bin."""
    rows = _read_staged(spark, staged).repartition("load_id", "status", "_bin")
    (rows.sortWithinPartitions("load_id", "status", "_bin").select(*GOOD_COLUMNS, "load_id")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_id", "status").parquet(_data(path)))


def _record_compaction(spark: SparkSession, path: str, name: str, staged: str, done: bool) -> None:
    (spark.createDataFrame([(name, staged, _now(), done)], _COMPACTION).coalesce(1)
          .write.mode("append").parquet(f"{path.rstrip('/')}/_compactions"))


def finish_compactions(spark: SparkSession, path: str) -> None:
    """Put compactions in place that were staged and recorded, but not ended."""
    for r in read_optional(spark, f"{path.rstrip('/')}/_compactions", _COMPACTION).groupBy("compaction", "staged").agg(
            F.max("done").alias("done"), F.min("at").alias("at")).where("NOT done").orderBy("at").collect():
        _put_in_place(spark, path, r["staged"])
        _record_compaction(spark, path, r["compaction"], r["staged"], True)


_FILES = "load_id bigint, source_file string, length bigint, modified timestamp"


def record_files(files: DataFrame, path: str, load_id: int) -> None:
    """Note the landing files of a load in the table's manifest."""
    (files.select(F.lit(load_id).cast("bigint").alias("load_id"), "source_file", "length", "modified")
          .write.mode("append").parquet(f"{path.rstrip('/')}/_files"))


def loaded_files(spark: SparkSession, path: str, but: int | None = None) -> DataFrame:
    """source_file, length, modified of the landing files that recorded loads have read, other
    than load ``but`` (which is about to be run, or run again)."""
    noted = read_optional(spark, f"{path.rstrip('/')}/_files", _FILES)
    ended = read_optional(spark, _loads(path), _LOADS_DDL)
    if but is not None:
        noted = noted.where(F.col("load_id") != but)
    return noted.join(ended, "load_id", "left_semi").select("source_file", "length", "modified").distinct()


def layout_by_status(df: DataFrame) -> DataFrame:
    """T4: hash distribution by status as a rebalance (AQE splits a hot status)."""
    return df.hint("rebalance", "status")


def layout_sorted(df: DataFrame, num_files: int | None = None) -> DataFrame:
    """Output files each sorted by status. ``num_files`` fixes the file count (the
    reference writes 2); by default AQE sizes the files (rebalance to the advisory size), so
    the write never narrows to a handful of tasks on large inputs."""
    spread = df.repartition(num_files) if num_files else df.hint("rebalance")
    return spread.sortWithinPartitions("status")


def layout_few_files(df: DataFrame, max_files: int | None = None) -> DataFrame:
    """T12 (DLQ side): few files. By default as many as the rows need at the session's advisory
    size, so the width grows with them; ``max_files`` fixes a number (the reference has 3), for
    outputs known to be small. Either way the work above keeps its own parallelism."""
    return df.repartition(max_files) if max_files else df.hint("rebalance")


def write_parquet(df: DataFrame, path: str, mode: str = "append", partition_by: list[str] | None = None,
                  max_records_per_file: int | None = None) -> None:
    """Plain Parquet write (DLQ folder)."""
    w = df.write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_serving(df: DataFrame, fmt: str = "jdbc", options: dict | None = None, mode: str = "append",
                  path: str | None = None) -> None:
    """Serving-store write. ``fmt='jdbc'`` takes caller options (url, dbtable, driver,
    user, password; the driver jar must be on the classpath); any file format writes to
    ``path``."""
    w = df.write.format(fmt).mode(mode).options(**(options or {}))
    w.save(path) if path else w.save()


GOOD_TABLE_DDL = ("tx_id STRING, sender_id STRING, receiver_id STRING, amount DOUBLE, "
                  "currency STRING, status STRING, timestamp TIMESTAMP")
DLQ_TABLE_DDL = (GOOD_TABLE_DDL + ", raw_amount STRING, raw_status STRING, raw_epoch BIGINT, "
                 "reject_reasons ARRAY<STRING>, dlq_processed_at TIMESTAMP")


def create_tables(spark: SparkSession, database: str, location: str) -> None:
    """Catalog tables for the good rows (partitioned by status), the dead letters and
    the windowed statistics (with the ``window`` struct). Idempotent."""
    from transferlake.schemas import STATS_TABLE_DDL
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.transfers ({GOOD_TABLE_DDL}) "
              "USING parquet PARTITIONED BY (status)")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.dead_letters ({DLQ_TABLE_DDL}) USING parquet")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.windowed_stats ({STATS_TABLE_DDL}) USING parquet")


def drop_table(spark: SparkSession, name: str) -> None:
    """Explicit drop only (never part of a read path)."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def insert_rows(df: DataFrame, table: str) -> None:
    """Append rows to a named table, columns by name."""
    names = df.sparkSession.table(table).columns
    df.select(*names).write.insertInto(table)


def create_projection_view(spark: SparkSession, name: str, source: str, temporary: bool = False) -> DataFrame:
    """CREATE OR REPLACE view with 5 of the 7 columns, lasting unless ``temporary``."""
    spark.sql(f"CREATE OR REPLACE {'TEMP ' if temporary else ''}VIEW {name} AS "
              f"SELECT tx_id, amount, currency, status, timestamp FROM {source}")
    return spark.table(name)
