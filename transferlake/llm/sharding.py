"""Sharding (7): jump consistent hashing, in Spark functions only.

Law ``key``: the 64-bit key of a document (first half of the md5 of its id as text) and the
shard count decide its shard, by Lamping and Veach's jump hash; there is no ring table, and one
more shard takes a document only into itself. ``slot`` numbers the rows of a shard from 0 by
(doc_id, crc32, size): rows are numbered inside ranges of doc_id, and the rows of earlier
ranges are added, so no shard passes through one task.

Null texts have no bytes and the crc32 of the empty text; null ids hash as empty text and come
first in their shard. Repeated rows and equal ids share a shard and have slots of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transferlake.llm.common import bounds_of, default_ranges, documents, range_of, read

SHARDS = 8
# Fixed values of the published algorithm: its generator's multiplier, its 2^31 and 2^33.
_MULTIPLIER, _WORD, _TOP, _SHIFT = 2862933555777941757, 1 << 64, float(1 << 31), 1 << 33
_STATE = "struct<b:bigint,j:bigint,k:decimal(20,0)>"


def key_of(doc_id: Column) -> Column:
    """Unsigned 64-bit key."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 16), 16, 10).cast("decimal(20,0)")


def _number(n: int) -> Column:
    return F.lit(str(n)).cast("decimal(20,0)")


def jump(key: Column, shards: int) -> Column:
    """Shard (0-based) of the key. The jump grows at every step, so ``shards`` steps end it."""
    def step(s: Column, _: Column) -> Column:
        k = F.pmod(s["k"] * _number(_MULTIPLIER) + F.lit(1), _number(_WORD)).cast("decimal(20,0)")
        return F.when(s["j"] >= shards, s).otherwise(
            F.struct(s["j"].alias("b"), s["j"].alias("j"), k.alias("k")).cast(_STATE))

    def leap(s: Column, _: Column) -> Column:
        drawn = step(s, _)
        j = F.floor((drawn["b"] + 1) * (F.lit(_TOP) / (F.floor(drawn["k"] / _number(_SHIFT)) + 1).cast("double")))
        return F.when(s["j"] >= shards, s).otherwise(
            F.struct(drawn["b"].alias("b"), j.cast("bigint").alias("j"), drawn["k"].alias("k")).cast(_STATE))

    start = F.struct(F.lit(-1).alias("b"), F.lit(0).alias("j"), key.alias("k")).cast(_STATE)
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, leap, lambda s: s["b"]).cast("int")


def shard(docs: DataFrame, shards: int = SHARDS, text: bool = False) -> DataFrame:
    """doc_id, [text, lang, source, n_chars,] size, text_crc32, law, shard, slot, grown_shard."""
    whole = documents(docs)
    ranges = default_ranges(docs.sparkSession)
    bounds = bounds_of(whole, "doc_id", ranges)
    body = F.coalesce(F.col("text"), F.lit(""))
    crc = F.crc32(body.cast("binary"))
    # Rows without an id come first, in ranges of their text's crc32.
    place = F.when(F.col("doc_id").isNull(), F.floor(crc * ranges / (1 << 32)) - ranges).otherwise(range_of(F.col("doc_id"), bounds))
    keep = ["doc_id", "text", "lang", "source", "n_chars"] if text else ["doc_id"]
    rows = whole.select(
        *keep, (F.octet_length(body) + 1).cast("bigint").alias("size"), crc.alias("text_crc32"),
        F.lit("key").alias("law"), jump(key_of(F.col("doc_id")), shards).alias("shard"),
        jump(key_of(F.col("doc_id")), shards + 1).alias("grown_shard"), place.alias("_range"))
    # At most shards * ranges rows.
    before = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy("shard", "_range").agg(F.count(F.lit(1)).alias("_n"))
               .select("shard", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    inside = Window.partitionBy("shard", "_range").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("_in", F.row_number().over(inside)).join(F.broadcast(offsets), ["shard", "_range"])
            .select(*keep, "size", "text_crc32", "law", "shard",
                    (F.col("_before") + F.col("_in") - 1).cast("bigint").alias("slot"), "grown_shard"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents"))
