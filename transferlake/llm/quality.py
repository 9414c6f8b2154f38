"""Quality classifier (8): random Fourier features, ridge by summed normal equations, isotonic.

Each text becomes a vector of statistics (lengths, character classes, case, repetition,
lines). Standardised, it is mapped to ``FEATURES`` random cosines that approximate a Gaussian
kernel; ridge regression on them is solved from normal equations that every partition sums over
its own labelled rows (all of them, no sample), so the driver gets one matrix of fixed size.
Isotonic regression over equal-count bins of the labelled rows' outputs turns an output into
the score, the share of good texts at that output.

The statistics are stored once (a few numbers per text) and used for fitting and scoring.
Nulls and empty texts have the statistics of an empty text. A null or repeated doc_id is scored
like any other row; labels with a null id or label are not learned from, of repeated labels the
largest counts. Without labels of both classes every score is the labels' only class, or 1.0
where there are no labels: nothing is rejected without evidence.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transferlake.llm.common import DOCUMENT_COLUMNS, documents, in_fold, read, stored, take
from transferlake.llm.words import U, batches, shingles_of, word_table

STATS = ["log_bytes", "log_words", "letters", "uppercase", "digits", "spaces", "marks", "symbols", "beyond_ascii",
         "word_length", "word_spread", "distinct_words", "distinct_shingles", "capitalised", "upper_words",
         "lines_per_word", "distinct_lines", "stops", "pipes", "bangs"]
FEATURES = 320
WIDTH = 1.2          # kernel width, in units of the square root of the number of statistics
RIDGE = 1.0
BINS = 400

_CLASS = {"letters": [*range(65, 91), *range(97, 123), *range(128, 256)], "uppercase": list(range(65, 91)),
          "digits": list(range(48, 58)), "spaces": [9, 10, 11, 12, 13, 32], "marks": [33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63],
          "symbols": [35, 36, 37, 38, 42, 43, 47, 60, 61, 62, 64, 91, 92, 93, 94, 95, 96, 123, 124, 125, 126],
          "beyond_ascii": list(range(128, 256)), "stops": [46], "pipes": [124], "bangs": [33]}


def _distinct(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    return np.bincount(o[new], minlength=n)


def _some(texts: list) -> np.ndarray:
    n = len(texts)
    plain = np.frombuffer(b"\n".join((t or "").encode("utf-8", "surrogatepass") for t in texts) + b"\n", dtype=np.uint8)
    lengths = np.fromiter((len((t or "").encode("utf-8", "surrogatepass")) + 1 for t in texts), np.int64, n)
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    size = np.maximum(lengths - 1, 1).astype(float)
    raw, low_first, starts, ends, hashes, owner = word_table(texts)
    words = np.bincount(owner, minlength=n)
    some = np.maximum(words, 1).astype(float)
    out = {"log_bytes": np.log1p(lengths - 1), "log_words": np.log1p(words)}
    for name, codes in _CLASS.items():
        table = np.zeros(256, np.int64)
        table[codes] = 1
        total = np.concatenate(([0], np.cumsum(table[plain])))
        out[name] = (total[first + lengths - 1] - total[first]) / size
    long = (ends - starts).astype(float)
    out["word_length"] = np.bincount(owner, long, n) / some
    out["word_spread"] = np.sqrt(np.maximum(0, np.bincount(owner, long ** 2, n) / some - out["word_length"] ** 2))
    out["distinct_words"] = _distinct(hashes, owner, n) / some
    shingle, of = shingles_of(hashes, owner, n)
    out["distinct_shingles"] = _distinct(shingle, of, n) / np.maximum(1, np.bincount(of, minlength=n))
    # Case by place in the text as it stands; its words start where the spaces before them end.
    space = np.zeros(256, bool)
    space[_CLASS["spaces"]] = True
    upper = np.zeros(256, bool)
    upper[_CLASS["uppercase"]] = True
    gap = space[plain]
    starts_here = np.flatnonzero(~gap & np.concatenate(([True], gap[:-1])))
    at = np.searchsorted(first, starts_here, side="right") - 1
    tokens = np.maximum(1, np.bincount(at, minlength=n))
    caps = upper[plain[starts_here]]
    second = upper[plain[np.minimum(starts_here + 1, len(plain) - 1)]]
    out["capitalised"] = np.bincount(at, caps, n) / tokens
    out["upper_words"] = np.bincount(at, caps & second, n) / tokens
    lines = [(t or "").split("\n") for t in texts]
    out["lines_per_word"] = np.array([len(x) for x in lines]) / some
    out["distinct_lines"] = np.array([len(set(x)) / len(x) for x in lines])
    return np.stack([out[s] for s in STATS], axis=1)


def text_stats(texts: list) -> np.ndarray:
    return np.concatenate([_some(texts[a:b]) for a, b in batches(texts)]) if len(texts) else np.zeros((0, len(STATS)))


def _cosines(x: np.ndarray, mean: np.ndarray, std: np.ndarray) -> np.ndarray:
    rng = np.random.default_rng(20)
    w = rng.normal(size=(len(STATS), FEATURES)) / (WIDTH * np.sqrt(len(STATS)))
    z = np.clip((x - mean) / std, -8, 8)
    return np.concatenate([np.cos(z @ w + rng.uniform(0, 2 * np.pi, FEATURES)) * np.sqrt(2 / FEATURES), np.ones((len(x), 1))], axis=1)


def _rows(pdf: pd.DataFrame) -> np.ndarray:
    return np.array(pdf["stats"].tolist(), dtype=float).reshape(len(pdf), len(STATS))


def isotonic(value: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots (value, rising share of good)."""
    blocks: list[list[float]] = []
    for v, g, w in zip(value, good, weight):
        blocks.append([v * w, g, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


class Model:
    """Means, spreads, ridge weights and isotonic knots; ``constant`` where nothing was learned."""

    def __init__(self, mean=None, std=None, ridge=None, knots=None, constant=None):
        self.mean, self.std, self.ridge, self.knots, self.constant = mean, std, ridge, knots, constant

    def raw(self, x: np.ndarray) -> np.ndarray:
        return _cosines(x, self.mean, self.std) @ self.ridge

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.constant) if self.constant is not None else np.interp(self.raw(x), *self.knots)


def with_stats(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns of documents + stats array<double>."""
    def run(parts):
        for pdf in parts:
            yield pdf[keep].assign(stats=list(text_stats(pdf["text"].tolist())))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in documents(docs).select(*keep).schema)
    return documents(docs).select(*dict.fromkeys([*keep, "text"])).mapInPandas(run, schema + ", stats array<double>")


def train(stats: DataFrame, labels: DataFrame) -> Model:
    """``stats``: doc_id, stats. ``labels``: doc_id, quality."""
    known = (take(labels, doc_id="bigint", quality="int").where("doc_id IS NOT NULL AND quality IN (0, 1)")
             .groupBy("doc_id").agg(F.max("quality").alias("y")))
    rows = stats.select("doc_id", "stats").join(known, "doc_id").select("stats", "y")
    names = [F.col("stats")[i] for i in range(len(STATS))]
    first = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("good"),
                     F.array(*[F.avg(c) for c in names]).alias("mean"), F.array(*[F.stddev_pop(c) for c in names]).alias("std")).first()
    if not first["n"] or first["good"] in (0, first["n"]):
        return Model(constant=1.0 if not first["n"] or first["good"] else 0.0)
    mean, std = np.array(first["mean"]), np.maximum(np.array(first["std"]), 1e-6)
    size = FEATURES + 1

    def sums(parts):
        a, b, n = np.zeros((size, size)), np.zeros(size), 0
        for pdf in parts:
            z = _cosines(_rows(pdf), mean, std)
            a += z.T @ z
            b += z.T @ pdf["y"].to_numpy(float)
            n += len(pdf)
        if n:
            yield pd.DataFrame({"i": np.arange(size), "a": list(a), "b": b})

    def added(parts):
        total: dict[int, list] = {}
        for pdf in parts:
            for i, a, b in zip(pdf["i"], pdf["a"], pdf["b"]):
                old = total.get(i)
                total[i] = [a, b] if old is None else [old[0] + a, old[1] + b]
        if total:
            yield pd.DataFrame({"i": list(total), "a": [v[0] for v in total.values()], "b": [v[1] for v in total.values()]})

    shape = "i int, a array<double>, b double"
    # A partition sends one row per line of the matrix; lines are added up by their number.
    got = sorted(rows.mapInPandas(sums, shape).repartition("i").mapInPandas(added, shape).collect())
    a, b = np.array([r["a"] for r in got]), np.array([r["b"] for r in got])
    model = Model(mean, std, np.linalg.solve(a + RIDGE * np.diag([1.0] * FEATURES + [0.0]), b))

    def outputs(parts):
        for pdf in parts:
            yield pd.DataFrame({"raw": model.raw(_rows(pdf)), "y": pdf["y"]})

    out = rows.mapInPandas(outputs, "raw double, y int")
    cuts = sorted(set(out.approxQuantile("raw", [i / BINS for i in range(1, BINS)], 0.25 / BINS)))
    bins = out.groupBy(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("raw"))).alias("bin"))
    knots = sorted((r["raw"], r["good"], r["n"]) for r in bins.agg(F.avg("raw").alias("raw"), F.sum("y").alias("good"), F.count(F.lit(1)).alias("n")).collect())
    model.knots = isotonic(*(np.array(x, dtype=float) for x in zip(*knots)))
    return model


def scored(stats: DataFrame, model: Model) -> DataFrame:
    """Every column of ``stats`` but the statistics, + score double, predicted int."""
    keep = [c for c in stats.columns if c != "stats"]

    def run(parts):
        for pdf in parts:
            p = np.clip(model.score(_rows(pdf)), 0, 1)
            yield pdf[keep].assign(score=p, predicted=(p >= 0.5).astype("int32"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stats.select(*keep).schema)
    return stats.mapInPandas(run, schema + ", score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents (their five columns) that the classifier does not reject. The model is fitted
    on the stored statistics; the texts are then read once more and judged as they pass."""
    model = train(stored(with_stats(docs, ["doc_id"]), "quality"), labels)

    def run(parts):
        for pdf in parts:
            yield pdf[model.score(text_stats(pdf["text"].tolist())) >= 0.5]
    whole = documents(docs)
    return whole.mapInPandas(run, whole.schema).select(*DOCUMENT_COLUMNS)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    held = in_fold(F.col("doc_id"), 3, 1)
    stats = stored(with_stats(docs, ["doc_id"]), "quality")
    return scored(stats, train(stats, labels.where(~held))).select("doc_id", held.alias("held_out"), "score", "predicted")
