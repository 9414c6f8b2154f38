"""Benchmark decontamination (2): size-partitioned MinHash containment search.

Benchmark items are partitioned by size: an item of n word shingles (five words) belongs to the
class of the least power of two, at least 16, that is not below n. For each class every document
is seen as windows of twice the class size, half overlapping, so that a passage as long as the
item lies whole in one window and the window's Jaccard similarity to it can't be small however
long the document is. A window and an item of the class are a candidate if any of ``HASHES``
MinHash values agree; a passage that holds 0.8 of an item is missed with a chance of about 1e-6.
Every candidate is verified: the item's distinct shingles found anywhere in the document, over
all of the item's; ``THRESHOLD`` of them is a leak.

An item with fewer distinct shingles than half its class size (a short one, or one whose
shingles repeat each other) has too few for MinHash; any of its shingles in a document makes a
candidate. Items of fewer than five words have no shingle of
five and never count; nor do null texts.

Equal items are searched for once. Their shingle sets and MinHash values are made in tasks and
written; indexes of about ``BLOCK`` hashes (some 150 MB) go to the tasks one after another, each
in one more scan of the documents. Documents are scanned whole and, with one index, never
shuffled. Null and empty texts hold nothing; a null or repeated doc_id is a row like any other,
repeated items are items.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transferlake.llm.common import documents, read, stored, take
from transferlake.llm.words import U, batches, mix, shingle_table, shingles_of, word_table

THRESHOLD = 0.8
WIDTH = 5
HASHES = 64
LEAST_CLASS = 16
BLOCK = 12_000_000          # 64-bit hashes of an index: shingles and MinHash values

_KEYS = mix(np.arange(1, 2 * HASHES + 1, dtype=U))
_XOR, _MUL = _KEYS[:HASHES], _KEYS[HASHES:] | U(1)


def signed(nodes: list, texts: list) -> list[tuple]:
    """(node, size class, distinct shingles, their hashes, MinHash values) of the texts of at least
    one shingle. Class 0, without MinHash values, has too few shingles for them."""
    out = []
    for a, b in batches(texts):
        _, _, _, _, words, of = word_table(texts[a:b])
        counts = np.bincount(of, minlength=b - a)
        hashes, owner = shingles_of(words, of, b - a, WIDTH)
        cuts = np.searchsorted(owner, np.arange(b - a + 1))
        for i in np.flatnonzero(counts >= WIDTH):
            row = hashes[cuts[i]:cuts[i + 1]]
            own, size = np.unique(row), max(LEAST_CLASS, 1 << int(len(row) - 1).bit_length())
            few = len(own) < size // 2
            low = np.array([] if few else [((own ^ x) * m).min() for x, m in zip(_XOR, _MUL)], dtype=U)
            out.append((nodes[a + i], 0 if few else size, len(own), own.tobytes(), low.tobytes()))
    return out


class Items:
    """An index of signed items: MinHash values by size class, and exact shingle sets."""

    def __init__(self, rows: list):
        self.ids, sizes = [r[0] for r in rows], np.array([r[1] for r in rows], dtype=np.int64)
        counts = np.array([r[2] for r in rows], dtype=np.int64)
        hashes = np.frombuffer(b"".join(bytes(r[3]) for r in rows), U)
        self.sets = np.split(hashes, np.cumsum(counts)[:-1])
        self.classes = {}
        for size in np.unique(sizes[sizes > 0]):
            numbers = np.flatnonzero(sizes == size).astype(np.int32)
            values = np.frombuffer(b"".join(bytes(rows[i][4]) for i in numbers), U).reshape(-1, HASHES)
            order = np.argsort(values, axis=0, kind="stable")
            self.classes[int(size)] = [(values[order[:, k], k], numbers[order[:, k]]) for k in range(HASHES)]
        short = np.flatnonzero(np.repeat(sizes == 0, counts))
        order = short[np.argsort(hashes[short], kind="stable")]
        self.rare, self.rare_of = hashes[order], np.repeat(np.arange(len(rows)), counts)[order]

    def candidates(self, hashes: np.ndarray, owner: np.ndarray) -> set:
        """(text, item number) pairs that share a MinHash value in some window."""
        out: set = set()
        if not len(hashes):
            return out
        if len(self.rare):
            left, right = np.searchsorted(self.rare, hashes), np.searchsorted(self.rare, hashes, side="right")
            for i in np.flatnonzero(right > left):
                out |= {(int(owner[i]), int(n)) for n in self.rare_of[left[i]:right[i]]}
        if not self.classes:
            return out
        first = np.searchsorted(owner, owner)
        block = (np.arange(len(owner)) - first) // LEAST_CLASS
        key = np.flatnonzero(np.concatenate(([True], (block[1:] != block[:-1]) | (owner[1:] != owner[:-1]))))
        base_of, base_block = owner[key], block[key]
        levels = {}
        for size in sorted(self.classes):
            group = base_block // (size // LEAST_CLASS)
            at = np.flatnonzero(np.concatenate(([True], (group[1:] != group[:-1]) | (base_of[1:] != base_of[:-1]))))
            levels[size] = (at, base_of[at])
        for k in range(HASHES):
            low = np.minimum.reduceat((hashes ^ _XOR[k]) * _MUL[k], key)
            for size, (at, of) in levels.items():
                part = np.minimum.reduceat(low, at)
                window = part.copy()
                joined = of[1:] == of[:-1]
                window[:-1][joined] = np.minimum(part[:-1], part[1:])[joined]
                values, numbers = self.classes[size][k]
                left = np.searchsorted(values, window)
                hit = np.flatnonzero(values[np.minimum(left, len(values) - 1)] == window)
                for i in hit:
                    stop = np.searchsorted(values, window[i], side="right")
                    out |= {(int(of[i]), int(n)) for n in numbers[left[i]:stop]}
        return out

    def found(self, texts: list) -> list[tuple[int, int, int]]:
        """(text, item number, shared shingles) of every verified leak."""
        out = []
        for a, b in batches(texts):
            hashes, owner = shingle_table(texts[a:b], WIDTH)
            by_text: dict[int, list[int]] = {}
            for t, n in self.candidates(hashes, owner):
                by_text.setdefault(t, []).append(n)
            for t in sorted(by_text):
                lo, hi = np.searchsorted(owner, [t, t + 1])
                own = np.unique(hashes[lo:hi])
                for n in sorted(by_text[t]):
                    item = self.sets[n]
                    at = np.minimum(np.searchsorted(own, item), len(own) - 1)
                    shared = int((own[at] == item).sum())
                    if shared >= THRESHOLD * len(item):
                        out.append((a + t, n, shared))
        return out


def _texts(benchmark: DataFrame) -> DataFrame:
    """item_id, node (md5 of the text), text of the items that have one."""
    items = take(benchmark, item_id="bigint", text="string").where("text IS NOT NULL")
    return items.select("item_id", F.md5(F.col("text").cast("binary")).alias("node"), "text")


def _blocks(items: DataFrame, block: int):
    """Broadcast indexes of the items' different texts, signed in tasks, about ``block`` hashes in
    each, and whether one holds all. A block is let go when the next is asked for."""
    def run(parts):
        for pdf in parts:
            yield pd.DataFrame(signed(pdf["node"].tolist(), pdf["text"].tolist()), columns=["node", "size", "n", "hashes", "low"])

    made = items.select("node", "text").distinct().mapInPandas(run, "node string, size bigint, n bigint, hashes binary, low binary")
    made = stored(made, "items")
    blocks = -(-int(made.agg(F.sum(F.col("n") + HASHES)).first()[0] or 0) // block)
    for i in range(blocks):
        part = made.where(F.pmod(F.xxhash64("node"), F.lit(blocks)) == i)
        rows = sorted((tuple(r) for r in part.collect()), key=lambda r: r[0])
        if rows:
            index = items.sparkSession.sparkContext.broadcast(Items(rows))
            yield index, blocks == 1
            if blocks > 1:
                index.unpersist()


def leaks(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, item_id, shared, item_shingles, containment: one row per document and item."""
    shape = "doc_id string, node string, shared bigint, item_shingles bigint, containment double"
    rows, items = documents(docs).select(F.col("doc_id").cast("string").alias("doc_id"), "text"), _texts(benchmark)

    def search(index):
        def run(parts):
            items = index.value
            for pdf in parts:
                ids = pdf["doc_id"].tolist()
                made = [(ids[t], items.ids[n], s, len(items.sets[n]), s / len(items.sets[n]))
                        for t, n, s in items.found(pdf["text"].tolist())]
                yield pd.DataFrame(made, columns=["doc_id", "node", "shared", "item_shingles", "containment"])
        return run

    out = rows.sparkSession.createDataFrame([], shape)
    for index, alone in _blocks(items, block):
        one = rows.mapInPandas(search(index), shape)
        out = one if alone else out.unionByName(stored(one, "leaks"))
    out = out.join(items.select("item_id", "node"), "node")
    return out.select(F.col("doc_id").cast("bigint").alias("doc_id"), "item_id", "shared", "item_shingles", "containment")


def decontaminated(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """Documents (their five columns) that hold no benchmark item: a filter on the scan, or, where
    the items need several blocks, an anti join with the md5 of the texts that do."""
    rows = documents(docs)
    marked = rows.select(F.md5(F.col("text").cast("binary")).alias("node"), "text")
    held = marked.select("node").limit(0)

    def holds(index, pdf):
        bad = {t for t, _, _ in index.value.found(pdf["text"].tolist())}
        return np.array([i in bad for i in range(len(pdf))], dtype=bool)

    def clean(index):
        return lambda parts: (pdf[~holds(index, pdf)] for pdf in parts)

    def dirty(index):
        return lambda parts: (pdf.loc[holds(index, pdf), ["node"]] for pdf in parts)

    for index, alone in _blocks(_texts(benchmark), block):
        if alone:
            return rows.mapInPandas(clean(index), rows.schema)
        held = held.unionByName(stored(marked.mapInPandas(dirty(index), "node string").distinct(), "held"))
    return (rows.withColumn("_node", F.md5(F.col("text").cast("binary")))
            .join(held.withColumnRenamed("node", "_node"), "_node", "left_anti").select(*rows.columns))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


_WORDS = r"regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x40\x5B-\x5E\x60\x7B-\x7F]+')"
OP2_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL),
     i AS (SELECT row_number() OVER () AS q, item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
     ds AS (SELECT DISTINCT r, doc_id, array_to_string(w[g:g + {WIDTH - 1}], ' ') AS s
            FROM (SELECT r, doc_id, w, unnest(generate_series(1, len(w) - {WIDTH - 1})) AS g FROM d)),
     qs AS (SELECT DISTINCT q, item_id, array_to_string(w[g:g + {WIDTH - 1}], ' ') AS s
            FROM (SELECT q, item_id, w, unnest(generate_series(1, len(w) - {WIDTH - 1})) AS g FROM i)),
     n AS (SELECT q, count(*) AS item_shingles FROM qs GROUP BY q)
SELECT doc_id, item_id, count(*) AS shared, item_shingles, count(*) / item_shingles::DOUBLE AS containment
FROM ds JOIN qs USING (s) JOIN n USING (q)
GROUP BY r, doc_id, q, item_id, item_shingles HAVING count(*) >= {THRESHOLD} * item_shingles
"""
