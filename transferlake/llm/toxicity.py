"""Toxicity (1): character n-gram linear classifier on naive Bayes log-count ratios.

A text's features are the hashed character n-grams (4 to 6 code points of the lower-cased
text, 2^18 buckets) it holds, each worth the log ratio of its smoothed frequency in toxic and
in other labelled texts; a logistic regression on those values gives the score. N-grams whose
frequency differs by less than four standard errors are left out, so that the many neutral
n-grams of a long text don't drown the few telling ones.

The model is fitted on a bounded sample: at most ``max_per_class`` labelled ids of either
class, those with the smallest hash, and as many different rows of them. Sample texts are featurised where they are scanned and
fitted in one task of at most 2 * ``max_per_class`` rows; the model (2^18 numbers) is what the
driver gets. Scoring is one scan of whole texts, no shuffle.

Nulls and empty texts score as a text without n-grams. A null or repeated doc_id is scored like
any other row; labels with a null id or label are not learned from, of repeated labels the
largest counts. Without labels of both classes the score is the share of toxic labels (0 if
there are none).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from transferlake.llm.common import documents, in_fold, read, take
from transferlake.llm.fit import lbfgs
from transferlake.llm.words import U, batches, mix

ORDERS = (4, 5, 6)
BITS = 18
MAX_PER_CLASS = 2000
MIN_SIGMA = 4.0                       # log ratios nearer to 0 than so many standard errors count as 0


def ngram_buckets(texts: list, orders=ORDERS, bits: int = BITS):
    """Yields (buckets, text of each) per order, for the texts of one batch."""
    parts = [np.frombuffer(((t or "").lower() + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for t in texts]
    points = np.concatenate(parts).astype(U) + U(1)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    for n in orders:
        full = max(0, len(points) - n + 1)
        sums = np.full(full, n, dtype=U)
        for j in range(n):
            sums *= U(0x100000001B3)
            sums += points[j:j + full]
        whole = owner[:full] == owner[n - 1:n - 1 + full]
        yield (mix(sums[whole]) >> U(64 - bits)).astype(np.int64), owner[:full][whole]


def _features(batches_in):
    for pdf in batches_in:
        out = []
        for text in pdf["text"]:
            found = [b for b, _ in ngram_buckets([text])]
            out.append(np.unique(np.concatenate(found)).astype(np.int32))
        yield pd.DataFrame({"y": pdf["y"].astype("int32"), "buckets": out})


def _fit(batches_in):
    size = 1 << BITS
    rows, on, off = [], np.zeros(size), np.zeros(size)
    for pdf in batches_in:
        for y, found in zip(pdf["y"], pdf["buckets"]):
            found = np.asarray(found, dtype=np.int32)
            (on if y else off)[found] += 1
            rows.append((y, found))
    rows.sort(key=lambda r: (r[0], len(r[1]), r[1].tobytes()))     # the same model in whatever order rows come
    y = np.array([r[0] for r in rows], dtype=np.float64)
    if len(set(y)) < 2:
        yield pd.DataFrame({"weights": [np.zeros(size, np.float32).tobytes()], "bias": [0.0]})
        return
    ratio = np.log((on + 1) / (on.sum() + size)) - np.log((off + 1) / (off.sum() + size))
    p1, p0 = (on + 1) / (y.sum() + 2), (off + 1) / ((1 - y).sum() + 2)
    spread = np.sqrt((1 - p1) / (on + 1) + (1 - p0) / (off + 1))
    ratio[np.abs(np.log(p1 / p0)) < MIN_SIGMA * spread] = 0        # may differ by chance alone
    telling = [found[ratio[found] != 0] for _, found in rows]
    index, owner = np.concatenate(telling).astype(np.int64), np.repeat(np.arange(len(rows)), [len(t) for t in telling])
    value = ratio[index]

    def loss(v):
        margin = np.bincount(owner, value * v[index], len(y)) + v[-1]
        p = 0.5 * (1 + np.tanh(margin / 2))
        err = p - y
        fit = np.logaddexp(0, margin).sum() - (y * margin).sum()
        grad = np.append(np.bincount(index, value * err[owner], size), err.sum()) + 0.5 * np.append(v[:-1], 0)
        return fit + 0.25 * (v[:-1] @ v[:-1]), grad

    v = lbfgs(loss, np.zeros(size + 1), 60)
    weights = v[:-1] * ratio
    yield pd.DataFrame({"weights": [weights.astype(np.float32).tobytes()], "bias": [float(v[-1])]})


def train(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS) -> tuple[np.ndarray, float]:
    """(weight per bucket, bias). ``labels``: doc_id, toxic."""
    known = (take(labels, doc_id="bigint", toxic="int").where("doc_id IS NOT NULL AND toxic IN (0, 1)")
             .groupBy("doc_id").agg(F.max("toxic").alias("y")))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    if not counts.get(0) or not counts.get(1):
        return np.zeros(1 << BITS, np.float32), 40.0 if share else -40.0
    sample = None
    for y in (0, 1):
        one = known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_per_class)
        sample = one if sample is None else sample.unionByName(one)
    texts = documents(docs).select("doc_id", "text").join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id", "text"])
    # Ids may repeat: rows are bounded too, of different ones.
    rank = F.row_number().over(Window.partitionBy("y").orderBy(F.xxhash64("doc_id", "text"), "doc_id", "text"))
    texts = texts.withColumn("_rank", rank).where(F.col("_rank") <= max_per_class).select("y", "text")
    made = (texts.mapInPandas(_features, "y int, buckets array<int>").repartition(1)
            .mapInPandas(_fit, "weights binary, bias double").collect())
    if not made:
        return np.zeros(1 << BITS, np.float32), -40.0
    # Back from the sample's share of toxic rows to the labels' own.
    drawn = min(counts[1], max_per_class) / min(counts[0], max_per_class)
    return np.frombuffer(made[0]["weights"], np.float32).copy(), made[0]["bias"] + float(np.log(counts[1] / counts[0] / drawn))


def margins(texts: list, weights: np.ndarray, bias: float) -> np.ndarray:
    out = np.full(len(texts), bias)
    for a, b in batches(texts, 1 << 19):
        for bucket, owner in ngram_buckets(texts[a:b]):
            hit = np.flatnonzero(weights[bucket])
            once = np.unique(owner[hit] * (1 << BITS) + bucket[hit])
            out[a:b] += np.bincount(once >> BITS, weights[once & ((1 << BITS) - 1)], b - a)
    return out


def score(docs: DataFrame, weights: np.ndarray, bias: float) -> DataFrame:
    """documents' columns + score double, predicted int."""
    def run(parts):
        for pdf in parts:
            p = 0.5 * (1 + np.tanh(margins(pdf["text"].tolist(), weights, bias) / 2))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "score": p, "predicted": (p >= 0.5).astype("int32")})
    return documents(docs).select("doc_id", "text").mapInPandas(run, "doc_id bigint, score double, predicted int")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    held = in_fold(F.col("doc_id"), 5, 0)
    scored = score(docs, *train(docs, labels.where(~held)))
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")
