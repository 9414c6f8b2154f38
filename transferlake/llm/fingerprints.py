"""Document fingerprints (5): threshold-scaled sketch, in Spark functions only.

The sketch of a text is every hash of its word shingles (five words; a shorter text has one
shingle, all its words) below a fixed fraction of the hash range. The sketch of a union is the
union of sketches, and the share of one sketch found in another estimates containment however
unequal the texts are. A text none of whose hashes is that small keeps its smallest one, so
that short texts can be compared; such an entry is told by its size when sketches are merged.
A fingerprint is the sketch's hashes in rising order, 12 hex digits each.

Likeness of two sketches is shared / all hashes: 1 for equal texts and for two texts without
words, 0 for a text with and one without.

Null texts count as empty. The next document is that of the next doc_id (null first; equal ids
by text, so repeated rows follow each other), after the last the first; a lone document is its
own next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transferlake.llm.common import bounds_of, default_ranges, documents, range_of, read, stored

WORD = r"[0-9a-z_\x{80}-\x{10FFFF}]+"
WIDTH = 5
HASH_BITS = 48
FRACTION = 8                # one hash in so many is kept
_FIRST = -(1 << 63)


def with_sketch(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: the sketch (rising array<bigint>) of column ``text``."""
    # Word hashes are a column of their own: read five times below, they are worked out once.
    df = df.withColumn("_words", F.regexp_extract_all(F.lower(F.col(text)), F.lit(WORD), F.lit(0)))
    df = df.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    n, word = F.size("_hashes"), lambda i: F.get("_hashes", i)
    low = lambda h: h.bitwiseAND(F.lit((1 << HASH_BITS) - 1))
    shingles = (F.when(n >= WIDTH, F.transform(F.sequence(F.lit(0), F.greatest(n - WIDTH, F.lit(0))), lambda i: low(F.xxhash64(*[word(i + j) for j in range(WIDTH)]))))
                .when(n > 0, F.array(low(F.xxhash64(F.concat_ws(" ", "_words")))))
                .otherwise(F.array().cast("array<bigint>")))
    df = df.withColumn("_shingles", shingles)
    small = F.array_sort(F.array_distinct(F.filter("_shingles", lambda h: h < (1 << HASH_BITS) // FRACTION)))
    df = df.withColumn("_small", small)
    kept = (F.when((F.size("_small") > 0) | (F.size("_shingles") == 0), F.col("_small")).otherwise(F.array(F.array_min("_shingles"))))
    return df.withColumn(out, kept).drop("_words", "_hashes", "_shingles", "_small")


def digits(sketch: str) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), HASH_BITS // 4, "0")), "")


def likeness(a: str, b: str) -> Column:
    both, any_ = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(any_ == 0, 1.0).otherwise(both / any_)


def containment(a: str, b: str) -> Column:
    """Estimated share of text a's shingles that text b has."""
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """doc_id, text, sketch, next_text, next_sketch.

    Rows are put in order inside ranges of doc_id; the first row of every range (at most
    ``ranges`` ids, a small table) stands again at the end of the range before it, that of the
    first range at the end of the last."""
    whole = documents(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(_FIRST)).alias("_key"))
    bounds = bounds_of(whole, "doc_id", ranges or default_ranges(docs.sparkSession))
    rows = whole.withColumn("_range", range_of(F.col("_key"), bounds))
    # One row for each range; the optimizer broadcasts it, or not, by the size it is stored with.
    in_order = Window.orderBy("_range")
    heads = rows.groupBy("_range").agg(F.min("_key").alias("_head"))
    last = F.last("_range").over(in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = stored(heads.select("_head", F.coalesce(F.lag("_range").over(in_order), last).alias("_before")), "fingerprint-heads")
    ends = whole.join(heads, whole["_key"] == heads["_head"]).groupBy("_key", "_before").agg(F.min("text").alias("text"))
    ends = ends.select(F.lit(None).cast("bigint").alias("doc_id"), "text", "_key", F.col("_before").alias("_range"), F.lit(1).alias("_end"))
    every = with_sketch(rows.withColumn("_end", F.lit(0)).unionByName(ends), "text", "sketch")
    order = Window.partitionBy("_range").orderBy("_end", "_key", "text")
    return (every.withColumn("next_text", F.lead("text").over(order)).withColumn("next_sketch", F.lead("sketch").over(order))
            .where("_end = 0").select("doc_id", "text", "sketch", "next_text", "next_sketch"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_next(read(spark, sf_dir, "documents")).withColumn("n_chars", F.length("text").cast("bigint"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - quarter), F.substring("next_text", F.lit(1), quarter))
    rows = with_sketch(rows.withColumn("edited", edited), "edited", "edited_sketch")
    return rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       digits("sketch").alias("fingerprint"), digits("edited_sketch").alias("edited_fingerprint"),
                       likeness("sketch", "edited_sketch").alias("near_edited"), likeness("sketch", "next_sketch").alias("near_next"))
