"""Table queries: write loads of V3 into a lake table, read back (state, history, as-of,
rollback, file listing)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transferlake.functions import instant_to_ntz
from transferlake.plans.views import Views, for_oracle
from transferlake.session import shared_dir, stored
from transferlake.sources import tables as tb

DLQ_DDL = tb.DLQ_TABLE_DDL

# Loads are transfer years; the first load and the 1998 load are full reloads (replace).
RELOAD_YEAR = 1998
AS_OF_YEAR = 2000
ROLLBACK_TO_YEAR = 1997


def _year():
    return F.year(instant_to_ntz(F.col("timestamp")))


def _yearly_loads(spark: SparkSession, sf_dir: str, name: str) -> str:
    path = shared_dir(spark, "tables", name, unique=True)
    tb.write_loads(Views(spark, sf_dir).good, path, _year(),
                   lambda load_id, first: "replace" if load_id in (first, RELOAD_YEAR) else "append")
    return path


def load_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replace hides what was there (first the pre-1998 rows, then everything)."""
    good = Views(spark, sf_dir).good
    path = shared_dir(spark, "tables", "replace", unique=True)
    tb.write_load(good.where(_year() < RELOAD_YEAR), path, 0, "replace")
    tb.write_load(good, path, 1, "replace")
    return for_oracle(tb.read_table(spark, path))


def load_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replace with the pre-1998 rows, append the rest."""
    good = Views(spark, sf_dir).good
    path = shared_dir(spark, "tables", "append", unique=True)
    tb.write_load(good.where(_year() < RELOAD_YEAR), path, 0, "replace")
    tb.write_load(good.where(_year() >= RELOAD_YEAR), path, 1, "append")
    return for_oracle(tb.read_table(spark, path))


def load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest 5 loads (commit time is wall clock, so it is left out of the check)."""
    path = _yearly_loads(spark, sf_dir, "history")
    return tb.load_history(spark, path, 5).select("load_id", "operation", "n_rows")


def table_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _yearly_loads(spark, sf_dir, "asof")
    return for_oracle(tb.read_table(spark, path, as_of=AS_OF_YEAR))


def table_rollback(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _yearly_loads(spark, sf_dir, "rollback")
    tb.rollback(spark, path, ROLLBACK_TO_YEAR)
    return for_oracle(tb.read_table(spark, path))


def table_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7 (rows-only check: file names are not reproducible)."""
    path = _yearly_loads(spark, sf_dir, "files")
    return tb.table_files(spark, path).select(
        "file_path", "record_count", "file_size_in_bytes", F.to_json("partition").alias("partition"))


def table_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T7 checked part: rows per partition of the current table state, summed from the
    per-file record counts (file names and counts are left out: they depend on the writer's
    task layout)."""
    path = _yearly_loads(spark, sf_dir, "partitions")
    return tb.partition_summary(spark, path).select("load_id", "status", "record_count")


QUERIES = {
    "load_replace": load_replace,
    "load_append": load_append,
    "load_history": load_history,
    "table_as_of": table_as_of,
    "table_rollback": table_rollback,
    "table_files": table_files,
    "table_partitions": table_partitions,
}


def _landing_job(spark: SparkSession, sf_dir: str, name: str, rows=None) -> str:
    from transferlake.plans.jobs import load_landing
    from transferlake.sources import landing
    base = shared_dir(spark, "jobs", name, unique=True)
    raw = Views(spark, sf_dir).raw
    landing.write_landing(raw if rows is None else raw.where(rows), f"{base}/landing")
    load_landing(spark, f"{base}/landing", f"{base}/table", f"{base}/dlq", 1, "replace")
    return base


def landing_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job end to end: landing CSV in, good table out (read back)."""
    base = _landing_job(spark, sf_dir, "landing_load")
    return for_oracle(tb.read_table(spark, f"{base}/table"))


def landing_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same job's dead-letter output (read back, processing stamp left out)."""
    base = _landing_job(spark, sf_dir, "landing_dlq")
    dlq = spark.read.schema(DLQ_DDL).parquet(f"{base}/dlq").drop("load_id", "dlq_processed_at")
    return for_oracle(dlq)


def _routes(spark: SparkSession, base: str) -> DataFrame:
    good = tb.read_table(spark, f"{base}/table").select("tx_id", F.lit("good").alias("route"))
    dlq = spark.read.schema("tx_id STRING").parquet(f"{base}/dlq")
    return good.unionByName(dlq.select("tx_id", F.lit("dlq").alias("route")))


def landing_all_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job on landing rows that are all dirty: an empty load, and every dead letter."""
    return _routes(spark, _landing_job(spark, sf_dir, "all_bad", F.expr("CAST(tx_id AS BIGINT) % 11 = 0")))


def landing_all_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job on landing rows that are all clean: no dead letter."""
    clean = "CAST(tx_id AS BIGINT) % 11 > 6 AND CAST(tx_id AS BIGINT) % 13 > 6 AND CAST(tx_id AS BIGINT) % 17 > 2"
    return _routes(spark, _landing_job(spark, sf_dir, "all_good", F.expr(clean)))


def dlq_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters appended to a Parquet folder in two writes, read back."""
    dlq, path = Views(spark, sf_dir).dlq, shared_dir(spark, "tables", "dlq", unique=True)
    odd = F.col("tx_id").cast("bigint") % 2 == 1
    tb.write_parquet(tb.layout_few_files(dlq.where(odd)), path)
    tb.write_parquet(tb.layout_few_files(dlq.where(~odd)), path)
    return for_oracle(spark.read.schema(dlq.schema).parquet(path))


def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named tables filled in two inserts, read through a lasting view."""
    good = Views(spark, sf_dir).good
    path = shared_dir(spark, "catalog", unique=True)
    database = "lake_" + path.rsplit("/", 1)[-1]
    tb.create_tables(spark, database, path)
    tb.insert_rows(good.where(_year() < RELOAD_YEAR), f"{database}.transfers")
    tb.insert_rows(good.where(_year() >= RELOAD_YEAR), f"{database}.transfers")
    return for_oracle(tb.create_projection_view(spark, f"{database}.transfers_view", f"{database}.transfers"))


def catalog_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The named table with the window struct, filled from the windowed statistics."""
    from transferlake.operators import stats
    from transferlake.plans.views import MONEY_SCALE
    path = shared_dir(spark, "catalog", unique=True)
    database = "lake_" + path.rsplit("/", 1)[-1]
    tb.create_tables(spark, database, path)
    flat = stats.sliding_stats(Views(spark, sf_dir).enriched, money_scale=MONEY_SCALE)
    tb.insert_rows(stats.nest_window(flat), f"{database}.windowed_stats")
    return for_oracle(stats.flatten_window(spark.table(f"{database}.windowed_stats")))


def table_files_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listed files' record counts, by load."""
    path = _yearly_loads(spark, sf_dir, "files_total")
    return tb.table_files(spark, path).groupBy(F.col("partition.load_id").alias("load_id")).agg(F.sum("record_count").alias("record_count"))


QUERIES.update({
    "landing_load": landing_load,
    "landing_dead_letters": landing_dead_letters,
    "landing_all_bad": landing_all_bad,
    "landing_all_good": landing_all_good,
    "dlq_append": dlq_append,
    "catalog_tables": catalog_tables,
    "catalog_stats": catalog_stats,
    "table_files_total": table_files_total,
})


def table_rollback_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Back to 1997, a load on top, back to a year after the reload, and back to that load:
    the state is 1997's and the load's."""
    path = _yearly_loads(spark, sf_dir, "rollback_twice")
    tb.rollback(spark, path, ROLLBACK_TO_YEAR)
    last = tb.loads(spark, path).agg(F.max("load_id")).first()[0]
    late = Views(spark, sf_dir).good.where(_year() >= AS_OF_YEAR)
    tb.write_load(late, path, last + 1, "append")
    tb.rollback(spark, path, AS_OF_YEAR)
    tb.rollback(spark, path, last + 1)
    return for_oracle(tb.read_table(spark, path))


def landing_only_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing folder loaded, loaded again, and again with new files in it; every row is
    there once."""
    from transferlake.plans.jobs import load_landing
    from transferlake.sources import landing
    base, raw = shared_dir(spark, "jobs", "only_new", unique=True), Views(spark, sf_dir).raw
    first = F.col("tx_id").cast("bigint") % 4 != 0
    landing.write_landing(raw.where(first), f"{base}/landing")
    for load_id in (1, 2):
        load_landing(spark, f"{base}/landing", f"{base}/table", f"{base}/dlq", load_id, only_new=True)
    landing.write_landing(raw.where(~first), f"{base}/landing", mode="append")
    load_landing(spark, f"{base}/landing", f"{base}/table", f"{base}/dlq", 3, only_new=True)
    return _routes(spark, base)


def load_sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: a second load in files of a target size, learned from the first; read back."""
    good, path = Views(spark, sf_dir).good, shared_dir(spark, "tables", "sized", unique=True)
    tb.write_load(good.where(_year() < RELOAD_YEAR), path, 0, "replace")
    tb.write_load(good.where(_year() >= RELOAD_YEAR), path, 1, "append", target_bytes=1 << 16)
    return for_oracle(tb.read_table(spark, path))


def catalog_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named tables dropped one by one; what the catalog lists before and after."""
    path = shared_dir(spark, "catalog", unique=True)
    database = "lake_" + path.rsplit("/", 1)[-1]
    tb.create_tables(spark, database, path)
    tb.insert_rows(Views(spark, sf_dir).good, f"{database}.transfers")
    n = spark.table(f"{database}.transfers").agg(F.count(F.lit(1)).alias("n_rows"))
    tb.drop_table(spark, f"{database}.dead_letters")
    tb.drop_table(spark, f"{database}.dead_letters")
    left = spark.sql(f"SHOW TABLES IN {database}").agg(F.array_join(F.array_sort(F.collect_list("tableName")), ",").alias("tables"))
    return n.join(left)


def dlq_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dead letter carries the time of its run, one for all of them."""
    from transferlake.operators import cleaning
    rows = stored(cleaning.dlq_rows(Views(spark, sf_dir).tagged), "dlq-stamped")
    span = F.max("dlq_processed_at") - F.min("dlq_processed_at")
    recent = F.max("dlq_processed_at") > F.current_timestamp() - F.expr("INTERVAL 1 HOUR")
    return rows.agg(F.count("dlq_processed_at").alias("stamped"), (span == F.expr("INTERVAL 0 SECOND")).alias("one_time"), recent.alias("recent"))


def compact_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compact every load of the yearly table; the current state must be unchanged."""
    path = _yearly_loads(spark, sf_dir, "compact")
    tb.compact_files(spark, path)
    return for_oracle(tb.read_table(spark, path))


def layout_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: V3 written with the hash-by-status layout (partitioned by status), read back."""
    path = shared_dir(spark, "tables", "bystatus", unique=True)
    tb.layout_by_status(Views(spark, sf_dir).good).write.partitionBy("status").parquet(path)
    return for_oracle(spark.read.parquet(path).select(*Views(spark, sf_dir).good.columns))


def layout_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3 written as files each sorted by status, read back."""
    path = shared_dir(spark, "tables", "sorted", unique=True)
    tb.layout_sorted(Views(spark, sf_dir).good).write.parquet(path)
    return for_oracle(spark.read.parquet(path))


def files_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per landing file, from one glob read (rows-only: file names vary)."""
    from transferlake.sources import landing
    path = shared_dir(spark, "landing", "by_source", unique=True)
    landing.write_landing(Views(spark, sf_dir).raw, path)
    return landing.files_by_source(landing.read_landing(spark, path, with_source=True))


def files_by_source_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files' row counts, added up."""
    return files_by_source(spark, sf_dir).agg(F.sum("n_rows").alias("n_rows"))


QUERIES.update({
    "table_rollback_twice": table_rollback_twice,
    "landing_only_new": landing_only_new,
    "load_sized": load_sized,
    "catalog_drop": catalog_drop,
    "dlq_stamped": dlq_stamped,
    "files_by_source_total": files_by_source_total,
    "compact_files": compact_files,
    "layout_by_status": layout_by_status,
    "layout_sorted": layout_sorted,
    "files_by_source": files_by_source,
})
