"""Vector code compression (13): product codes by integer Walsh-Hadamard search.

A vector's entries become integers, floor(``scale`` * x), cut into ``parts`` equal consecutive
parts; a part is coded as the nearest entry of its position's codebook. Part and entries are
zero-padded to a power of two P and transformed by the integer Walsh-Hadamard transform, which
multiplies every squared distance by P. Coefficients are compared in sequency order, where the
first ones hold most of the distance: a partial sum never falls, so an entry whose partial sum
exceeds the whole distance of the entry that the first coefficient favours is dropped, and the
few that stay are summed to the end. All arithmetic is on integers (int64, or Python's own where
entries are too large for it), so distances, ties and averages are exact and equal in any order
of rows.

Codebooks start as the parts of the ``entries`` rows with the smallest vec_id (nulls last, ties
by vector). Each of ``rounds`` rounds assigns every part and replaces each entry by
floor(sum / count) of its parts; unused entries stay. A round is one scan; tasks send one row
for each used entry, added up by entry, so the driver gets codebooks only.

Kept are rows whose vector is not null and has only finite entries; repeated and null vec_ids
are rows like any other. Vectors shorter than the longest, or a length ``parts`` doesn't divide,
are filled up with zeros at the end. Fewer kept rows than ``entries`` make fewer entries; no
kept row makes no row. An error beyond a long is null, as is then the sum of its label.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transferlake.llm.common import read, stored
from transferlake.llm.vectors import kept, whole

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
ROWS = 4096                 # vectors compared at once, of 64 entries


def hadamard(a: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the last axis (a power of two long), in natural order."""
    lead, n, half = a.shape[:-1], a.shape[-1], 1
    while half < n:
        pair = a.reshape(*lead, n // (2 * half), 2, half)
        a = np.stack((pair[..., 0, :] + pair[..., 1, :], pair[..., 0, :] - pair[..., 1, :]), axis=-2).reshape(*lead, n)
        half *= 2
    return a


def sequency(n: int) -> np.ndarray:
    """Natural numbers of the transform's rows, by their number of sign changes."""
    signs = hadamard(np.eye(n, dtype=np.int64))
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(axis=1), kind="stable")


def transformed(a: np.ndarray) -> np.ndarray:
    """Coefficients of the zero-padded last axis, in sequency order."""
    size = 1 << max(0, a.shape[-1] - 1).bit_length()
    padded = np.zeros((*a.shape[:-1], size), a.dtype)
    padded[..., :a.shape[-1]] = a
    return hadamard(padded)[..., sequency(size)]


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, squared distance) of each point, both given as transformed;
    of equal distances the lowest index."""
    n, size = points.shape
    first = points[:, :1] - entries[:, 0]
    partial = first * first
    favoured = entries[partial.argmin(axis=1)]
    bar = ((points - favoured) ** 2).sum(axis=1)
    row, entry = np.nonzero(partial <= bar[:, None])
    total, at, step = partial[row, entry], 1, 1
    while at < size:
        gap = points[row, at:at + step] - entries[entry, at:at + step]
        total = total + (gap * gap).sum(axis=1)
        on = total <= bar[row]
        row, entry, total = row[on], entry[on], total[on]
        at, step = at + step, 2 * step
    np.minimum.at(bar, row, total)
    hit = total == bar[row]
    return entry[hit][np.unique(row[hit], return_index=True)[1]], bar // size


class Codebooks:
    """``books[part][entry][position]``: Python integers."""

    def __init__(self, books: list, scale: int):
        self.books, self.scale = books, scale
        self.parts, self.entries, self.length = len(books), len(books[0]), len(books[0][0])
        self.width = self.parts * self.length
        # Products of transformed differences, summed over a vector, stay below 2^63.
        self.limit = 2.0 ** ((60 - 2 * max(1, self.width).bit_length()) // 2)
        large = any(abs(x) >= self.limit for part in books for e in part for x in e)
        self.array = np.array(books, object if large else np.int64).reshape(self.parts, self.entries, self.length)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(x) for part in self.books for e in part for x in e).encode()).hexdigest()

    def assigned(self, column: pa.Array):
        """Slices of a list column as (parts [row, part, position], codes, squared distances)."""
        size = max(1, ROWS * 64 // max(1, self.width))
        for at in range(0, len(column), size):
            x = whole(column.slice(at, size), self.scale, self.width, self.limit)
            books = self.array
            if object in (x.dtype, books.dtype):
                x, books = x.astype(object), books.astype(object)
            x = x.reshape(len(x), self.parts, self.length)
            points, entries = transformed(x), transformed(books)
            found = [nearest(points[:, p], entries[p]) for p in range(self.parts)]
            yield x, np.stack([c for c, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def _sums(books: Codebooks):
    def run(batches):
        total = np.zeros((books.parts, books.entries, books.length), object)
        count = np.zeros((books.parts, books.entries), np.int64)
        for batch in batches:
            for x, codes, _ in books.assigned(batch.column(0)):
                for p in range(books.parts):
                    own = np.zeros((books.entries, books.length), x.dtype)
                    np.add.at(own, codes[:, p], x[:, p])
                    total[p] += own
                    count[p] += np.bincount(codes[:, p], minlength=books.entries)
        used = np.argwhere(count > 0)
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([int(p) for p, _ in used], pa.int32()), "entry": pa.array([int(e) for _, e in used], pa.int32()),
            "n": pa.array([int(count[p, e]) for p, e in used], pa.int64()),
            "total": pa.array([[str(x) for x in total[p, e]] for p, e in used], pa.list_(pa.string()))})
    return run


def _added(batches):
    n: dict[tuple, int] = {}
    total: dict[tuple, list] = {}
    for batch in batches:
        for r in batch.to_pylist():
            key = r["part"], r["entry"]
            n[key] = n.get(key, 0) + r["n"]
            total[key] = [a + int(b) for a, b in zip(total.get(key, [0] * len(r["total"])), r["total"])]
    yield pa.RecordBatch.from_pydict({
        "part": pa.array([p for p, _ in n], pa.int32()), "entry": pa.array([e for _, e in n], pa.int32()),
        "n": pa.array(n.values(), pa.int64()),
        "total": pa.array([[str(x) for x in v] for v in total.values()], pa.list_(pa.string()))})


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks | None:
    """Codebooks of the kept vectors; None where there are none."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    rows = kept(vectors)
    first = rows.select("vec_id", "embedding").orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).collect()
    if not first:
        return None
    longest = rows.agg(F.max(F.size("embedding"))).first()[0]
    length = -(-longest // parts)
    start = whole(pa.array([r["embedding"] for r in first], pa.list_(pa.float64())), scale, parts * length, 2.0 ** 52).reshape(len(first), parts, length)
    books = Codebooks([[[int(x) for x in start[e, p]] for e in range(len(first))] for p in range(parts)], scale)
    shape = "part int, entry int, n bigint, total array<string>"
    for _ in range(rounds):
        sums = rows.select("embedding").mapInArrow(_sums(books), shape).repartition("part", "entry").mapInArrow(_added, shape)
        moved = [list(part) for part in books.books]
        for r in sums.collect():
            moved[r["part"]][r["entry"]] = [int(x) // r["n"] for x in r["total"]]
        books = Codebooks(moved, scale)
    return books


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label (as text), code, error of every kept vector."""
    def run(batches):
        for batch in batches:
            codes, errors = [], []
            for _, code, distance in books.assigned(batch.column(2)):
                text = code.astype(np.uint8).tobytes().hex()
                codes += [text[i:i + 2 * books.parts] for i in range(0, len(text), 2 * books.parts)]
                errors += [int(e) if e < 1 << 63 else None for e in distance.sum(axis=1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(errors, pa.int64())],
                                             ["vec_id", "label", "code", "error"])
    rows = kept(vectors).select("vec_id", "label", "embedding")
    return rows.mapInArrow(run, "vec_id bigint, label string, code string, error bigint")


def coded(vectors: DataFrame, **how) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256."""
    books = train(vectors, **how)
    if books is None:
        return vectors.sparkSession.createDataFrame([], "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string")
    rows = stored(encode(vectors, books), "codes")
    # Both sides are stored: a label with a third of all rows is a skewed join that Spark splits.
    by_label = stored(rows.groupBy("label").agg(
        F.when(F.count("error") == F.count(F.lit(1)), F.sum(F.col("error").cast("decimal(20,0)"))).try_cast("bigint").alias("label_error")), "codes-labels")
    named = by_label.withColumnRenamed("label", "_label")
    return (rows.join(named, rows["label"].eqNullSafe(named["_label"]))
            .select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded(read(spark, sf_dir, "embeddings"))
