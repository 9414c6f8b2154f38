"""N-gram Jaccard join (10): MinHash bands, Bayesian candidate pruning, exact verification.

Texts are sets of word shingles (five words; fewer: one shingle, all words). Equal texts form a
class and one of them stands for all. The join is over these representatives:

1. ``HASHES`` MinHash values a text; bands of ``ROWS`` values put texts into buckets. A pair at
   similarity 0.8 shares none of the buckets with a chance of about 5e-8.
2. Bucket mates are compared value by value, ``STEP`` at a time. After each step the posterior
   (uniform prior, so Beta(agreed + 1, missed + 1)) probability that the similarity reaches the
   threshold is looked up; a pair below ``TOLERANCE`` is dropped, the rest go on to the end.
3. Survivors' connected components hold every link. Inside a component all pairs are verified
   on the exact shingle sets; links are counted and joined into groups.

No pair is ever a row. A bucket or component of many texts is cut into blocks; each pair of
blocks is one unit of work for a task, which gives back one row per text: its number of links
and the least member it hangs together with. Copies are not expanded: a link counts as many
documents as its classes hold. Components come from alternating star contraction on those
few rows, each round written to the shared folder.

Null and empty texts, and texts without words, link only to equal ones (null equals empty).
``class_id`` is the least doc_id of the connected group (null if it has none). Repeated rows
are copies; rows of one doc_id and different texts are different texts.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transferlake.llm.common import DOCUMENT_COLUMNS, documents, read, stored
from transferlake.llm.words import U, batches, mix, shingle_sets, shingle_table

THRESHOLD = 0.8
ROWS, BANDS = 4, 32
HASHES = ROWS * BANDS
STEP = 16
TOLERANCE = 1e-6
BLOCK = 384                 # texts of a block
BLOCK_SHINGLES = 400_000    # and about so many shingles

_KEYS = mix(np.arange(101, 2 * HASHES + 101, dtype=U))
_XOR, _MUL = _KEYS[:HASHES], _KEYS[HASHES:] | U(1)


# --- signatures ------------------------------------------------------------------------------

def signatures(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(16-bit MinHash values [text, HASHES], band keys [text, BANDS], number of shingles)."""
    small, keys, counts = [], [], []
    for a, b in batches(texts):
        hashes, owner = shingle_table(texts[a:b])
        n = b - a
        count = np.bincount(owner, minlength=n)
        some = np.flatnonzero(count)
        low = np.zeros((n, HASHES), U)
        if len(some):
            first = np.searchsorted(owner, some)
            for k in range(HASHES):
                low[some, k] = np.minimum.reduceat((hashes ^ _XOR[k]) * _MUL[k], first)
        low = mix(low)
        key = np.zeros((n, BANDS), U)
        for j in range(ROWS):
            key = mix(key ^ low[:, j::ROWS])
        key = mix(key + np.arange(1, BANDS + 1, dtype=U))
        small.append((low & U(0xFFFF)).astype(np.uint16))
        keys.append(key.view(np.int64))
        counts.append(count)
    return np.concatenate(small), np.concatenate(keys), np.concatenate(counts)


def bars(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> np.ndarray:
    """Least number of agreeing values after STEP, 2 STEP, ... HASHES for a pair to go on: where
    P(similarity >= threshold | agreed of n) under a uniform prior first reaches ``tolerance``.
    That probability is a binomial tail: P(at most ``agreed`` of n + 1 draws at the threshold)."""
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        total, agreed = 0.0, 0
        for agreed in range(n + 1):
            total += math.comb(n + 1, agreed) * threshold ** agreed * (1 - threshold) ** (n + 1 - agreed)
            if total >= tolerance:
                break
        out.append(agreed)
    return np.array(out)


# --- units of work ---------------------------------------------------------------------------

def units(parts, key: list[str]):
    """Whole groups of a stream of batches sorted by ``key``, many small ones at a time."""
    held = None
    for pdf in parts:
        held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        last = held[key].iloc[-1]
        same = (held[key] == last).all(axis=1).to_numpy()
        cut = len(held) - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield held.iloc[:cut].reset_index(drop=True)
            held = held.iloc[cut:].reset_index(drop=True)
    if held is not None and len(held):
        yield held


def pairs_of(group: np.ndarray, side: np.ndarray, within: np.ndarray):
    """Row pairs to compare, in chunks: of each group all pairs (units of one block), or those
    across its two blocks. ``group`` must be sorted."""
    cuts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True])))
    out_a, out_b, held = [], [], 0
    sizes = np.diff(cuts)
    for size in np.unique(sizes[sizes < 24]):
        if size < 2:
            continue
        at = cuts[:-1][sizes == size]
        i, j = np.triu_indices(size, 1)
        for s in range(0, len(at), 1 + 400_000 // len(i)):
            a, b = (at[s:s + 1 + 400_000 // len(i), None] + i).ravel(), (at[s:s + 1 + 400_000 // len(i), None] + j).ravel()
            keep = within[a] | (side[a] != side[b])
            out_a.append(a[keep])
            out_b.append(b[keep])
            held += len(a)
            if held > 400_000:
                yield np.concatenate(out_a), np.concatenate(out_b)
                out_a, out_b, held = [], [], 0
    for at, size in zip(cuts[:-1][sizes >= 24], sizes[sizes >= 24]):
        i, j = np.triu_indices(size, 1)
        keep = within[at] | (side[at + i] != side[at + j])
        out_a.append(at + i[keep])
        out_b.append(at + j[keep])
        held += len(i)
        if held > 400_000:
            yield np.concatenate(out_a), np.concatenate(out_b)
            out_a, out_b, held = [], [], 0
    if out_a:
        yield np.concatenate(out_a), np.concatenate(out_b)


def least_linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least row that each of n rows hangs together with, by the links (a, b)."""
    low = np.arange(n)
    while len(a):
        m = np.minimum(low[a], low[b])
        before = low.copy()
        np.minimum.at(low, a, m)
        np.minimum.at(low, b, m)
        low = low[low]
        if (low == before).all():
            break
    return low


def in_blocks(rows: DataFrame, group: str, blocks, cols: list[str]) -> DataFrame:
    """Deals the rows of each group into ``blocks`` blocks and gives every pair of blocks (a block
    and itself too) the rows of both: unit columns _u, _v; ``side`` 0 or 1; sorted by unit."""
    mine = F.pmod(F.xxhash64("node", F.lit(7)), F.col("_blocks")).cast("int")
    # A block meets itself and about half of the others, as the first or the second of the pair.
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_o")
    dealt = rows.withColumn("_blocks", blocks.cast("int")).withColumn("_b", mine).select(group, *cols, "_blocks", "_b", other)
    dealt = dealt.select(group, *cols, F.least("_b", "_o").alias("_u"), F.greatest("_b", "_o").alias("_v"), (F.col("_b") > F.col("_o")).cast("int").alias("side"))
    return dealt.repartition(group, "_u", "_v").sortWithinPartitions(group, "_u", "_v", "node")


def _unit_numbers(pdf: pd.DataFrame, group: str) -> np.ndarray:
    g, u, v = (pdf[c].to_numpy() for c in (group, "_u", "_v"))
    new = np.concatenate(([True], (g[1:] != g[:-1]) | (u[1:] != u[:-1]) | (v[1:] != v[:-1])))
    return np.cumsum(new) - 1


# --- components ------------------------------------------------------------------------------

def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): the least node of each connected component, from edges (u, v).

    Nodes that hang on one smaller node only are set aside, so that the many leaves of a star
    don't meet again in every round; they take their neighbour's root at the end. The rest goes
    through alternating star contraction: each node passes its larger neighbours, then itself
    and its smaller ones, on to the least node it knows, until nothing changes."""
    edges = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    leaves = stored(both.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("m")).where("n = 1 AND m < u").select("u", "m"), "leaves")
    edges = stored(edges.join(leaves.select("u"), "u", "left_anti"), "edges")
    seen = None
    for _ in range(rounds):
        mark = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if not mark["n"] or seen == tuple(mark):
            break
        seen = tuple(mark)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v")))).where("u <> v").distinct()
        edges = stored(small, "edges")
    else:
        raise RuntimeError(f"components not found in {rounds} rounds")
    core = stored(edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")), "core")
    hung = leaves.join(core.withColumnRenamed("node", "m"), "m", "left").select(F.col("u").alias("node"), F.coalesce("root", "m").alias("root"))
    return core.unionByName(hung)


# --- the join --------------------------------------------------------------------------------

def classes(docs: DataFrame) -> DataFrame:
    """One row per different text: node (its md5, 16 bytes as hex), copies, doc_id (the least),
    sig, keys, shingles. Stored: signatures are made once."""
    rows = documents(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("node", F.md5(F.col("text").cast("binary")))

    def run(parts):
        for pdf in parts:
            sig, keys, counts = signatures(pdf["text"].tolist())
            yield pd.DataFrame({"node": pdf["node"], "doc_id": pdf["doc_id"], "sig": [s.tobytes() for s in sig], "keys": list(keys), "shingles": counts})

    made = rows.select("node", F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(
        run, "node string, doc_id string, sig binary, keys array<bigint>, shingles bigint")
    return stored(made.groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.min(F.col("doc_id").cast("bigint")).alias("doc_id"),
                                           F.first("sig").alias("sig"), F.first("keys").alias("keys"), F.first("shingles").alias("shingles")), "classes")


def survivors(reps: DataFrame) -> DataFrame:
    """Edges (u, v) that connect whatever Bayesian pruning leaves connected."""
    keyed = reps.where("shingles > 0").select("node", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    mates = keyed.join(shared, "key").join(reps.select("node", "sig"), "node")
    dealt = in_blocks(mates, "key", F.ceil(F.col("n") / BLOCK), ["node", "sig"])
    bar = bars()

    def run(parts):
        for pdf in units(parts, ["key", "_u", "_v"]):
            sig = np.frombuffer(b"".join(pdf["sig"]), np.uint16).reshape(len(pdf), HASHES)
            side, within = pdf["side"].to_numpy(), (pdf["_u"] == pdf["_v"]).to_numpy()
            node = pdf["node"].to_numpy()
            kept_a, kept_b = [], []
            for a, b in pairs_of(_unit_numbers(pdf, "key"), side, within):
                agreed = np.zeros(len(a), np.int64)
                for step, least in enumerate(bar):
                    cols = slice(step * STEP, (step + 1) * STEP)
                    agreed += (sig[a, cols] == sig[b, cols]).sum(axis=1)
                    on = agreed >= least
                    a, b, agreed = a[on], b[on], agreed[on]
                kept_a.append(a)
                kept_b.append(b)
            if kept_a:
                low = least_linked(len(pdf), np.concatenate(kept_a), np.concatenate(kept_b))
                at = np.flatnonzero(low != np.arange(len(pdf)))
                yield pd.DataFrame({"u": node[at], "v": node[low[at]]})

    return dealt.mapInPandas(run, "u string, v string")


def _linked(sets: list, side: np.ndarray, within: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows whose sets reach the threshold, from the product of their incidence
    matrices, a slice of the shingles at a time."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    every, number, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), sizes)
    useful = times[number] > 1                    # others are in one set only
    row, number = row[useful], (np.cumsum(times > 1) - 1)[number[useful]]
    shared = np.zeros((n, n), np.float32)
    width = max(1, 4_000_000 // n)
    order = np.argsort(number, kind="stable")
    row, number = row[order], number[order]
    for start in range(0, int(number[-1]) + 1 if len(number) else 0, width):
        lo, hi = np.searchsorted(number, [start, start + width])
        part = np.zeros((n, width), np.float32)
        part[row[lo:hi], number[lo:hi] - start] = 1
        shared += part @ part.T
    link = shared >= THRESHOLD * (sizes[:, None] + sizes[None, :] - shared) - 1e-6 * np.maximum(1, shared)
    a, b = np.nonzero(np.triu(link, 1))
    keep = within | (side[a] != side[b])
    a, b = a[keep], b[keep]
    both = shared[a, b].astype(np.int64)          # the threshold itself, in whole numbers
    exact = both * 10 >= round(THRESHOLD * 10) * (sizes[a] + sizes[b] - both)
    return a[exact], b[exact]


def links(docs: DataFrame, reps: DataFrame) -> DataFrame:
    """(node, root, linked documents): rows for texts with a link, from all units; a text has one
    row per unit it is in."""
    member = stored(components(survivors(reps)), "members")
    roots = member.select(F.col("root").alias("node"), "root").distinct()
    nodes = member.unionByName(roots).join(reps.select("node", "copies", "doc_id", "shingles"), "node")
    sizes = nodes.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("shingles").alias("s"))
    nodes = nodes.join(sizes, "root")
    texts = documents(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("node", F.md5(F.col("text").cast("binary")))
    # One row of each class has its text: that of the least doc_id; equal rows once.
    wanted = nodes.select("root", "node", "copies", "n", "s", F.col("doc_id").alias("_id"))
    found = (texts.join(wanted.withColumnRenamed("node", "_node"), (F.col("node") == F.col("_node")) & F.col("doc_id").eqNullSafe(F.col("_id")))
             .groupBy("root", "node", "copies", "n", "s").agg(F.first("text").alias("text")))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("s") / BLOCK_SHINGLES))
    dealt = in_blocks(found, "root", blocks, ["node", "copies", "text"])

    def run(parts):
        for pdf in units(parts, ["root", "_u", "_v"]):
            unit = _unit_numbers(pdf, "root")
            sets = shingle_sets(pdf["text"].tolist())
            node, copies = pdf["node"].to_numpy(), pdf["copies"].to_numpy()
            side, within = pdf["side"].to_numpy(), (pdf["_u"] == pdf["_v"]).to_numpy()
            cuts = np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1], [True])))
            out_a, out_b = [], []
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if hi - lo > 1:
                    a, b = _linked(sets[lo:hi], side[lo:hi], bool(within[lo]))
                    out_a.append(a + lo)
                    out_b.append(b + lo)
            if not out_a:
                continue
            a, b = np.concatenate(out_a), np.concatenate(out_b)
            n = len(pdf)
            degree = np.bincount(a, copies[b], n) + np.bincount(b, copies[a], n)
            low = least_linked(n, a, b)
            at = np.flatnonzero(degree > 0)
            yield pd.DataFrame({"node": node[at], "root": node[low[at]], "linked": degree[at].astype(np.int64)})

    return stored(dealt.mapInPandas(run, "node string, root string, linked bigint"), "links")


def groups(docs: DataFrame) -> DataFrame:
    """One row per different text: node, copies, doc_id (least), linked (documents of other texts
    it links to), class_id (least doc_id of its connected group)."""
    reps = classes(docs)
    found = links(docs, reps)
    root = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    degree = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    rows = (reps.select("node", "copies", "doc_id").join(root, "node", "left").join(degree, "node", "left")
            .select("node", "copies", "doc_id", F.coalesce("root", "node").alias("root"), F.coalesce("linked", F.lit(0)).alias("linked")))
    least = rows.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return rows.join(least, "root").select("node", "copies", "doc_id", "linked", "class_id", "root")


def join(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id, n_links (other documents at THRESHOLD or more,
    equal texts among them), n_copies (documents of equal text, itself included)."""
    node = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    rows = documents(docs).select("doc_id", node.alias("node"))
    return (rows.join(groups(docs).drop("doc_id", "root"), "node")
            .select("doc_id", "class_id", (F.col("linked") + F.col("copies") - 1).cast("bigint").alias("n_links"), F.col("copies").alias("n_copies")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """Documents (their five columns), one of each group of near copies: that of the least
    doc_id, and of rows that share it the least in order of the columns."""
    best = groups(docs).groupBy("root").agg(F.min_by("node", F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("node"),
                                            F.min("doc_id").alias("_id")).select("node", "_id")
    rows = documents(docs).withColumn("node", F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("d")
    kept = rows.join(best.alias("b"), (F.col("d.node") == F.col("b.node")) & F.col("d.doc_id").eqNullSafe(F.col("b._id")))
    rest = [c for c in DOCUMENT_COLUMNS]
    # Equal rows of a kept id once.
    return (kept.groupBy("d.node").agg(F.min(F.struct(*[F.col(f"d.{c}").alias(c) for c in rest])).alias("_row"))
            .select(*[F.col(f"_row.{c}").alias(c) for c in rest]))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(read(spark, sf_dir, "documents"))


_WORDS = r"regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x40\x5B-\x5E\x60\x7B-\x7F]+')"
OP10_SQL = f"""
WITH RECURSIVE c AS (SELECT coalesce(text, '') AS text, min(doc_id) AS first, count(*) AS copies FROM documents GROUP BY 1),
     t AS (SELECT row_number() OVER (ORDER BY text) AS r, first, copies, text, {_WORDS} AS w FROM c),
     s AS (SELECT DISTINCT r, array_to_string(w[g:g + 4], ' ') AS s
           FROM (SELECT r, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS g FROM t WHERE len(w) > 0)),
     n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
     p AS (SELECT a.r AS a, b.r AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.r <> b.r GROUP BY 1, 2),
     l AS (SELECT a, b FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 10 * k >= 8 * (x.n + y.n - k)),
     reach(a, b) AS (SELECT r, r FROM t UNION SELECT reach.a, l.b FROM reach JOIN l ON l.a = reach.b),
     g AS (SELECT reach.a AS r, min(t.first) AS class_id FROM reach JOIN t ON t.r = reach.b GROUP BY 1),
     d AS (SELECT l.a AS r, sum(t.copies) AS linked FROM l JOIN t ON t.r = l.b GROUP BY 1)
SELECT o.doc_id, g.class_id, CAST(coalesce(d.linked, 0) + t.copies - 1 AS BIGINT) AS n_links, t.copies AS n_copies
FROM documents o JOIN t ON t.text = coalesce(o.text, '') JOIN g USING (r) LEFT JOIN d USING (r)
"""
