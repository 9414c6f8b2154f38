"""Helpers the llm operators share: column intake, shared-folder tables, value ranges.

Operators take any DataFrame that has the columns they name; other columns, whatever their
names, are left behind at intake (``take``), so they cannot clash with working columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from transferlake.session import ensure_checkpoint_dir, shared_dir

DOCUMENT_TYPES = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}
DOCUMENT_COLUMNS = list(DOCUMENT_TYPES)


def take(df: DataFrame, **types: str) -> DataFrame:
    """The named columns, cast; a column the input lacks comes back as nulls."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(f"`{have[c.lower()]}`") if c.lower() in have else F.lit(None)).cast(t).alias(c)
                       for c, t in types.items()])


def documents(df: DataFrame) -> DataFrame:
    return take(df, **DOCUMENT_TYPES)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: its lineage is cut, so a lost
    executor costs a re-read and every later use sees the same rows."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = shared_dir(spark, "llm", name, unique=True)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounds_of(df: DataFrame, column: str, ranges: int) -> list:
    """At most ``ranges - 1`` rising cut points that split ``column`` into near-equal ranges."""
    if ranges < 2:
        return []
    probs = [i / ranges for i in range(1, ranges)]
    return sorted({int(b) for b in df.approxQuantile(column, probs, 0.25 / ranges)})


def range_of(column: Column, bounds: list) -> Column:
    """Number of cut points at or below the value (null: 0). Constant per value, so a retried
    task puts a row where its first attempt did. Every ``step``-th cut point is looked at first,
    then those after it, so the work grows with the square root of their number."""
    if not bounds:
        return F.lit(0)
    step = max(1, round(len(bounds) ** 0.5))
    # As one text each: thousands of cut points would make a large expression.
    listed = lambda cuts: F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")
    below = lambda cuts: F.size(F.filter(cuts, lambda b: b <= column))
    coarse = below(listed(bounds[::step]))
    fine = below(F.slice(listed(bounds), (coarse - 1) * step + 1, F.lit(step)))
    return F.when(column.isNull() | (column < bounds[0]), 0).otherwise((coarse - 1) * step + fine)


def default_ranges(spark: SparkSession) -> int:
    """Ranges to cut a table into: four for each shuffle partition of the session, 10,000 at
    most, since the cut points pass through the driver."""
    return min(10_000, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """crc32 of the id as text, mod ``folds``, equals ``fold``. A null id is in fold of ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold
