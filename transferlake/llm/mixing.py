"""Mixing sources to target weights (4), in Spark functions only.

A source's documents, by doc_id, are one stream of words cut into blocks of equal length: ``BLOCK``
words, fewer in a source of under ``FINE`` such blocks, down to ``LEAST_BLOCK``. The target of a
source fixes how many slots of the mix it fills. The slots are drawn into output shards, each
slot into any shard with the same chance, so that the shards' counts of a source are a
multinomial draw that adds up to its slots, whatever the number of shards (``shard_counts``).
Each shard fills the slots it drew: a source's slots, numbered through all shards, are mapped
through its pseudorandom permutation of block numbers (swap-or-not shuffle, another one for each
pass over the source), and blocks are joined by (source, number). A target of several times the
source goes through all blocks that many times, and through some in a last, partial pass.

Targets: sources by code point, null last, weigh 1, 2, 3, 1, ...; they share all words by
weight, a source takes at most 3 times its own words, and what it can't take goes to the others
by weight. A source's taken words differ from its target by a block at most: half a block by
rounding, and what its last block, which may be short, lacks. No block is taken more than once
a pass and there are at most 3 passes, so no document is taken more than 3 times.

Sources are a table like any other, numbered by range partitions and never collected; the
driver reads a few sums over it until the level of the targets settles. Streams are numbered
inside (source, range of doc_id), so one source of a third of all rows is split; rows without a
doc_id are dealt to ranges by their text.

Null and empty texts have size 0 and are never taken; null sources are one source; equal ids
and repeated rows stand beside each other in the stream, each on its own. A document's ``shards``
lists the words that each output shard takes of it, by shard: none for a document not taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transferlake.llm.common import DOCUMENT_COLUMNS, bounds_of, default_ranges, documents, range_of, read, stored
from transferlake.operators.ordering import running_number

WORD = r"[^\x20\x09-\x0D]+"
BLOCK, LEAST_BLOCK = 64, 4  # words
FINE = 256                  # blocks, from which on a source's are BLOCK words long
SLOTS = 1 << 16             # slots of an output shard, about
LEAST_SHARDS = 4
PASSES = 3
ROUNDS = 24
SEED = 4


def shuffled(x: Column, n: Column, *tweak: Column) -> Column:
    """Where a pseudorandom permutation of 0 .. n-1 (one per tweak) puts x: swap-or-not."""
    def turn(at: Column, i: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(F.lit(SEED), *tweak, i), n) - at, n)
        return F.when(F.xxhash64(F.greatest(at, other), F.lit(SEED), *tweak, i) % 2 == 0, other).otherwise(at)
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), x.cast("bigint"), turn)


def targets_of(sized: DataFrame) -> DataFrame:
    """source, source_size, weight, target, _s (number of the source from 1) from rows of (source,
    size). Stored. Shares by weight are held at PASSES times a source's size: the level (words a
    unit of weight) rises until the sources that it fills stay the same, a sum over
    the sources for each time it does."""
    sources = sized.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    sources = running_number(sources.withColumn("_none", F.col("source").isNull()), ["_none", "source"], "_s").drop("_none")
    sources = stored(sources.withColumn("weight", ((F.col("_s") - 1) % 3 + 1).cast("int")), "mix-sources")
    cap, level, full = F.col("source_size").cast("double") * PASSES, 0.0, -1
    while True:
        held = cap <= F.lit(level) * F.col("weight")
        now = sources.agg(F.sum("source_size").alias("all"), F.count_if(held).alias("full"), F.sum(F.when(held, cap)).alias("taken"),
                          F.sum(F.when(~held, F.col("weight"))).alias("weights")).first()
        if now["full"] == full or not now["weights"]:
            break
        full, level = now["full"], (now["all"] - (now["taken"] or 0.0)) / now["weights"]
    return sources.withColumn("target", F.least(cap, F.lit(float(level)) * F.col("weight")))


def with_slots(sources: DataFrame) -> DataFrame:
    """+ _length (words of a block), _blocks, _passes (whole ones) and _slots (of the last pass)."""
    size = F.col("source_size")
    length = F.least(F.lit(BLOCK), F.greatest(F.lit(LEAST_BLOCK), F.floor(size / FINE)))
    cut = sources.withColumn("_length", length.cast("bigint")).withColumn("_blocks", F.ceil(size / F.col("_length")).cast("bigint"))
    passes = F.when(size > 0, F.floor(F.col("target") / size + 1e-9)).otherwise(0)
    cut = cut.withColumn("_passes", F.least(F.lit(PASSES), passes).cast("int"))
    rest = F.greatest(F.lit(0.0), F.col("target") - F.col("_passes") * size) * F.col("_blocks") / size
    return cut.withColumn("_slots", F.when((size > 0) & (F.col("_passes") < PASSES), F.round(rest)).otherwise(0).cast("bigint"))


def cuts_of(docs: DataFrame) -> list:
    """Cut points of the doc_id ranges. Approximate, and not the same each time they are worked
    out: whatever is to be joined by range and number takes them from one call."""
    return bounds_of(documents(docs), "doc_id", default_ranges(docs.sparkSession))


def _streams(docs: DataFrame, keep: list[str], bounds: list) -> DataFrame:
    """Documents with size, order key and their range by the cut points."""
    whole = documents(docs)
    body = F.coalesce(F.col("text"), F.lit(""))
    # Rows without an id, of which there may be many, by their text.
    place = F.when(F.col("doc_id").isNull(), -1 - F.pmod(F.xxhash64(body), F.lit(len(bounds) + 1))).otherwise(range_of(F.col("doc_id"), bounds)).cast("bigint")
    return whole.select(*dict.fromkeys(["doc_id", "source", *keep]), F.regexp_count(body, F.lit(WORD)).cast("bigint").alias("size"),
                        F.xxhash64(body).alias("_hash"), place.alias("_range"))


def _numbered(rows: DataFrame) -> DataFrame:
    inside = Window.partitionBy("source", "_range").orderBy("doc_id", "size", "_hash")
    return (rows.withColumn("_in", F.row_number().over(inside))
            .withColumn("_start", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))


def _each(rows: DataFrame, slots: Column, *keys: str) -> DataFrame:
    """A row for each slot of each row, from 0. A few rows that become many are dealt by their
    keys to every task first, SLOTS slots each."""
    spark = rows.sparkSession
    first = F.explode(F.sequence(F.lit(0).cast("bigint"), slots - 1, F.lit(SLOTS).cast("bigint")))
    dealt = rows.where(slots > 0).withColumn("_all", slots).withColumn("_from", first)
    dealt = dealt.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys, "_from")
    return dealt.withColumn("_slot", F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + SLOTS, F.col("_all")) - 1))).drop("_from", "_all")


def _drawn(sources: DataFrame) -> DataFrame:
    """shard, source, _s, _blocks, slots: what the output shards draw of each source, all passes."""
    every = F.col("_passes") * F.col("_blocks") + F.col("_slots")
    shards = max(LEAST_SHARDS, -(-int(sources.agg(F.sum(every)).first()[0] or 0) // SLOTS))
    drawn = _each(sources, every, "_s").withColumn("shard", F.pmod(F.xxhash64(F.lit(SEED), F.lit("draw"), "_s", "_slot"), F.lit(shards)).cast("int"))
    return drawn.groupBy("shard", "source", "_s", "_blocks").agg(F.count(F.lit(1)).alias("slots"))


def shard_counts(docs: DataFrame) -> DataFrame:
    """shard, source, slots: what the output shards draw of each source, all passes."""
    sources = with_slots(targets_of(stored(_streams(docs, [], cuts_of(docs)), "mix").select("source", "size")))
    return _drawn(sources).select("shard", "source", "slots")


def _filled(sources: DataFrame) -> DataFrame:
    """(_s, _block, _pass, _shard): the block that each drawn slot takes. A shard's slots of a
    source come after those of the shards before it; a pass is as many slots as blocks."""
    earlier = Window.partitionBy("_s").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = _drawn(sources).drop("source").withColumn("_earlier", F.coalesce(F.sum("slots").over(earlier), F.lit(0)))
    slots = _each(counts, F.col("slots"), "_s", "shard").withColumn("_number", F.col("_earlier") + F.col("_slot"))
    slots = slots.withColumn("_pass", F.floor(F.col("_number") / F.col("_blocks")).cast("int"))
    return slots.select("_s", shuffled(F.pmod("_number", "_blocks"), F.col("_blocks"), F.col("_s"), F.col("_pass")).alias("_block"),
                        "_pass", F.col("shard").alias("_shard"))


def spans(docs: DataFrame, bounds: list) -> DataFrame:
    """One row per document, block it has words in and slot that takes the block: source and
    range keys, _first word, _stop, _pass, _shard. A block that no slot takes has one row without
    pass and shard, a document without words one without block."""
    sized = stored(_streams(docs, [], bounds), "mix")
    sources = stored(with_slots(targets_of(sized.select("source", "size"))), "mix-targets")
    rows = sized.join(sources.withColumnRenamed("source", "_name"), sized["source"].eqNullSafe(F.col("_name"))).drop("_name")
    before = Window.partitionBy("_s").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (rows.groupBy("_s", "_range").agg(F.sum("size").alias("_words"))
               .select("_s", "_range", F.coalesce(F.sum("_words").over(before), F.lit(0)).alias("_offset")))
    placed = _numbered(rows).join(offsets, ["_s", "_range"]).withColumn("_at", F.col("_offset") + F.col("_start"))
    last, length = F.col("_at") + F.col("size") - 1, F.col("_length")
    cut = placed.withColumn("_block", F.explode_outer(F.when(F.col("size") > 0, F.sequence(F.floor(F.col("_at") / length), F.floor(last / length)))))
    first = F.greatest(F.col("_block") * length - F.col("_at"), F.lit(0))
    stop = F.least((F.col("_block") + 1) * length - F.col("_at"), F.col("size"))
    # The optimizer takes the slots for as few as the sources they come from: never broadcast.
    joined = cut.join(_filled(sources).hint("merge"), ["_s", "_block"], "left")
    return joined.select("doc_id", "source", "size", "source_size", "target", "_range", "_in", "_block",
                         first.alias("_first"), stop.alias("_stop"), "_pass", "_shard")


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, shards (shard and words it takes, by
    shard): one row per document."""
    document = ["source", "_range", "_in", "doc_id", "size", "source_size", "target"]
    words = F.sum(F.when(F.col("_shard").isNotNull(), F.col("_stop") - F.col("_first")))
    by_shard = spans(docs, cuts_of(docs)).groupBy(*document, "_shard").agg(words.cast("bigint").alias("_words"))
    placed = F.when(F.col("_shard").isNotNull(), F.struct(F.col("_shard").alias("shard"), F.col("_words").alias("words")))
    return (by_shard.groupBy(*document)
            .agg(F.coalesce(F.sum("_words"), F.lit(0)).cast("bigint").alias("taken"), F.array_sort(F.collect_list(placed)).alias("shards"))
            .select("doc_id", "source", "size", "source_size", "target", "taken", "shards"))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix of all shards as documents: a row for each run of a document's blocks that is taken
    together, once for each time it is taken. A whole text stays as it is; a part is its words, single
    spaces between them."""
    bounds = cuts_of(docs)
    cut = spans(docs, bounds)
    run = Window.partitionBy("source", "_range", "_in", "_pass").orderBy("_block")
    runs = (cut.where(F.col("_pass").isNotNull()).withColumn("_run", F.col("_block") - F.row_number().over(run))
            .groupBy("source", "_range", "_in", "_pass", "_run").agg(F.min("_first").alias("_first"), F.max("_stop").alias("_stop"))
            .withColumnRenamed("source", "_source"))
    texts = _numbered(_streams(docs, DOCUMENT_COLUMNS, bounds)).alias("t")
    runs = runs.hint("merge").alias("r")
    both = texts.join(runs, F.col("t.source").eqNullSafe(F.col("r._source")) & (F.col("t._range") == F.col("r._range")) & (F.col("t._in") == F.col("r._in")))
    part = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), (F.col("_first") + 1).cast("int"), (F.col("_stop") - F.col("_first")).cast("int")), " ")
    piece = F.when((F.col("_first") == 0) & (F.col("_stop") == F.col("size")), F.col("text")).otherwise(part)
    return both.select("doc_id", piece.alias("text"), "lang", "source").withColumn("n_chars", F.length("text").cast("bigint")).select(*DOCUMENT_COLUMNS)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "shards")
