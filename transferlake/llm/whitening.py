"""Embedding whitening (12): scatter, eigenvectors and projection with MLlib's BlockMatrix.

Entries become whole numbers f = floor(``scale`` * c), x = f + ``SHIFT``. Rows are numbered into
blocks of ``BLOCK`` rows by the scan itself: block k of scan partition p is row block p * K + k
of the matrix (K: most blocks of a partition), short blocks are filled with zero rows and absent
ones are zeros. The blocks are stored (ids and whole numbers, one or two bytes an entry), so a
lost executor costs a re-read and every later step sees the same numbering.

Centred rows are exact to one rounding: (n * f - sum f) / n equals x - S / n. The BlockMatrix A of
them gives the scatter A'A by transpose and multiply, its middle dimension split so that no
task holds more than ``SPLIT`` blocks of either side; the dims x dims scatter is solved by
``numpy.linalg.eigh`` on the driver, and A times the whitening matrix U / sqrt(e) projects all
rows. The whitened covariance is then measured on the projected rows themselves.

Kept are rows whose vector is not null and has only finite entries; null or repeated vec_ids are
rows like any other. Shorter vectors are filled with zero entries (x = SHIFT). Whole numbers
beyond +-2^40 are held there. An eigenvalue that is zero within rounding has explained 0 and
whitened null, and is left out of the identity error (0 where no component is left). A
deviation beyond a long is null. No kept row gives no row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transferlake.llm.common import read, stored
from transferlake.llm.vectors import kept, whole

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
BLOCK = 1024                # rows of a block
SPLIT = 64                  # blocks that a task of the scatter holds of either side
BOUND = 1 << 40
_KINDS = [np.int8, np.int16, np.int32, np.int64]


def _narrow(f: np.ndarray) -> tuple[int, bytes]:
    """(bytes an entry, the entries)."""
    most = int(max(f.max(), -1 - f.min())) if f.size else 0
    kind = next(k for k in _KINDS if most <= np.iinfo(k).max)
    return np.dtype(kind).itemsize, f.astype(kind).tobytes()


def _wide(raw: bytes, size: int, rows: int, width: int) -> np.ndarray:
    """Entries of a stored block, filled up to ``width`` columns."""
    kind = next(k for k in _KINDS if np.dtype(k).itemsize == size)
    f = np.frombuffer(raw, kind).reshape(rows, -1).astype(np.int64)
    return np.pad(f, ((0, 0), (0, width - f.shape[1])))


def numbered_blocks(vectors: DataFrame, scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """Stored: part, k, n, dims, ids, size, f, sums; a row for each ``block`` kept rows of a
    partition of the scan."""
    def run(batches):
        k, ids, held, part = 0, [], [], 0

        def put(ids: list, f: np.ndarray) -> pa.RecordBatch:
            size, raw = _narrow(f)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int64()), "k": pa.array([k], pa.int64()), "n": pa.array([len(ids)], pa.int64()),
                "dims": pa.array([f.shape[1]], pa.int32()), "ids": pa.array([ids], pa.list_(pa.int64())), "size": pa.array([size], pa.int32()),
                "f": pa.array([raw], pa.binary()), "sums": pa.array([f.sum(axis=0).tolist()], pa.list_(pa.int64()))})

        def joined() -> np.ndarray:
            width = max(h.shape[1] for h in held)
            return np.concatenate([np.pad(h, ((0, 0), (0, width - h.shape[1]))) for h in held])

        for batch in batches:
            for at in range(0, batch.num_rows, block):
                piece = batch.slice(at, block)
                part = piece.column(0)[0].as_py()
                width = max(piece.column(2).value_lengths().to_pylist())
                f = whole(piece.column(2), scale, width, 2.0 ** 62)
                held.append(np.minimum(np.maximum(f, -BOUND), BOUND).astype(np.int64))
                ids += piece.column(1).to_pylist()
                while len(ids) >= block:
                    f = joined()
                    yield put(ids[:block], f[:block])
                    ids, held, k = ids[block:], [f[block:]] if len(ids) > block else [], k + 1
        if ids:
            yield put(ids, joined())
    rows = kept(vectors).select(F.spark_partition_id().cast("bigint").alias("part"), "vec_id", "embedding")
    shape = "part bigint, k bigint, n bigint, dims int, ids array<bigint>, size int, f binary, sums array<bigint>"
    return stored(rows.mapInArrow(run, shape), "whitening-blocks")


def _times(a: BlockMatrix, b: BlockMatrix, splits: int) -> BlockMatrix:
    """``a.multiply(b)`` with the middle dimension cut into ``splits``: an argument of the
    Scala method that the Python one leaves out. Without it one task would hold all of a product
    of one block."""
    product = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, a.rowsPerBlock, b.colsPerBlock)


class Whitening:
    """``sums`` (of f, by dimension) and ``n``; ``values``: falling eigenvalues of the
    components; ``matrix``: dims x usable components; ``trace`` of the covariance."""

    def __init__(self, n: int, sums: list, covariance: np.ndarray, components: int):
        self.n, self.sums = n, sums
        values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
        values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
        least = len(covariance) * np.finfo(float).eps * max(values[0], 0.0) if len(values) else 0.0
        self.trace, self.values = float(np.trace(covariance)), np.where(values > least, values, 0.0)
        self.usable = int((self.values > 0).sum())
        vectors = vectors[:, :self.usable]
        heavy = np.abs(vectors).argmax(axis=0) if self.usable else np.zeros(0, int)
        sign = np.where(vectors[heavy, np.arange(self.usable)] < 0, -1.0, 1.0)
        self.matrix = vectors * sign / np.sqrt(self.values[:self.usable])


def _gap(f: np.ndarray, n: int, sums: list) -> np.ndarray:
    """n * f - sums, exactly."""
    most = int(np.abs(f).max()) if f.size else 0
    if n * most < 1 << 61 and all(abs(s) < 1 << 61 for s in sums):
        return n * f - np.array(sums, np.int64)
    return f.astype(object) * n - np.array(sums, object)


def centred(blocks: DataFrame, n: int, sums: list, block: int) -> BlockMatrix:
    """The BlockMatrix of centred rows, from blocks with their ``number``."""
    width = len(sums)

    def made(row):
        gap = _gap(_wide(row["f"], row["size"], row["n"], width), n, sums)
        full = np.zeros((block, width))
        full[:row["n"]] = (gap / n).astype(float)
        return (row["number"], 0), DenseMatrix(block, width, full.ravel(order="F"))
    rows = blocks.select("number", "n", "size", "f")
    last = rows.agg(F.max("number")).first()[0]
    return BlockMatrix(rows.rdd.map(made), block, width, (last + 1) * block, width)


def fitted(blocks: DataFrame, components: int = COMPONENTS, block: int = BLOCK) -> tuple[Whitening, BlockMatrix] | None:
    """The whitening of stored blocks, and their matrix of centred rows (persisted)."""
    spark = blocks.sparkSession
    totals = blocks.agg(F.sum("n").alias("n"), F.max("dims").alias("dims"), F.count(F.lit(1)).alias("blocks")).first()
    if not totals["n"] or not totals["dims"]:
        return None
    each = blocks.select(F.posexplode("sums").alias("at", "f")).groupBy("at").agg(F.sum(F.col("f").cast("decimal(20,0)")).alias("f"))
    found = {r["at"]: int(r["f"]) for r in each.collect()}
    n, sums = int(totals["n"]), [found[i] for i in range(totals["dims"])]
    rows = centred(blocks, n, sums, block).persist(StorageLevel.DISK_ONLY)
    scatter = _times(rows.transpose(), rows, max(1, -(-totals["blocks"] // SPLIT)))
    return Whitening(n, sums, scatter.toLocalMatrix().toArray() / n, components), rows


def projected(blocks: DataFrame, model: Whitening, rows: BlockMatrix, block: int = BLOCK) -> DataFrame:
    """Stored: ids, deviations, usable, p (whitened rows of the block, row by row)."""
    spark = blocks.sparkSession
    width, k, n, sums = len(model.sums), model.usable, model.n, model.sums
    if k:
        turn = BlockMatrix(spark.sparkContext.parallelize([((0, 0), DenseMatrix(width, k, model.matrix.ravel(order="F")))], 1), width, k, width, k)
        found = rows.multiply(turn).blocks.map(lambda b: (b[0][0], bytearray(b[1].toArray().tobytes())))
    else:
        found = blocks.select("number").rdd.map(lambda r: (r["number"], bytearray()))
    found = spark.createDataFrame(found, "number bigint, p binary")

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                gap = _gap(_wide(r["f"], r["size"], r["n"], width), n, sums)
                most = max(abs(int(gap.max())), abs(int(gap.min())))
                square = (gap if width * most * most < 1 << 62 else gap.astype(object)) ** 2
                far = [int(x) if x < 1 << 63 else None for x in square.sum(axis=1)]
                yield pa.RecordBatch.from_pydict({"ids": pa.array([r["ids"]], pa.list_(pa.int64())), "deviations": pa.array([far], pa.list_(pa.int64())),
                                                  "p": pa.array([r["p"][:r["n"] * k * 8]], pa.binary())})
    joined = blocks.select("number", "n", "size", "ids", "f").join(found, "number")
    return stored(joined.mapInArrow(run, "ids array<bigint>, deviations array<bigint>, p binary"), "whitened")


def identity_error(whitened: DataFrame, n: int, k: int) -> float:
    """Largest absolute entry of (covariance of the whitened rows - identity); 0 without rows."""
    if not k:
        return 0.0
    shape = "i int, row array<double>"

    def means(batches):
        total = np.zeros(k)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                total += np.frombuffer(raw).reshape(-1, k).sum(axis=0)
        yield pa.RecordBatch.from_pydict({"i": pa.array([0], pa.int32()), "row": pa.array([total.tolist()], pa.list_(pa.float64()))})

    def added(rows: DataFrame) -> dict:
        each = rows.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
        return {(r["i"], r["j"]): r["v"] for r in each.collect()}

    p = whitened.select("p")
    total = added(p.mapInArrow(means, shape))
    mean = np.array([total[0, j] for j in range(k)]) / n

    def scatter(batches):
        total = np.zeros((k, k))
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                rows = np.frombuffer(raw).reshape(-1, k) - mean
                total += rows.T @ rows
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(k), pa.int32()), "row": pa.array(total.tolist(), pa.list_(pa.float64()))})
    total = added(p.mapInArrow(scatter, shape))
    return max(abs(v / n - (i == j)) for (i, j), v in total.items())


SCHEMA = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    blocks = numbered_blocks(vectors, scale, block)
    most = blocks.agg(F.max("k")).first()[0]
    blocks = blocks.withColumn("number", F.col("part") * ((most or 0) + 1) + F.col("k"))
    fit = fitted(blocks, components, block)
    if fit is None:
        return spark.createDataFrame([], SCHEMA)
    model, rows = fit
    found = projected(blocks, model, rows, block)
    rows._java_matrix_wrapper._java_model.blocks().unpersist(False)
    n, k, shown = model.n, model.usable, len(model.values)
    error = identity_error(found, n, k)
    explained = [float(e / model.trace) if model.trace > 0 else 0.0 for e in model.values]
    spare = np.full(shown - k, math.nan)

    def run(batches):
        for batch in batches:
            for ids, far, raw in zip(batch.column(0), batch.column(1), batch.column(2)):
                ids, far, p = ids.values, far.values, np.frombuffer(raw.as_py()).reshape(-1, k) if k else np.zeros((len(ids), 0))
                m = len(ids)
                p = np.concatenate((p, np.broadcast_to(spare, (m, shown - k))), axis=1).ravel()
                each = np.repeat(np.arange(m), shown)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, shown + 1, dtype=np.int32), m)), pa.array(np.full(len(each), n)),
                    far.take(pa.array(each)), pa.array(p, from_pandas=True), pa.array(np.tile(explained, m)), pa.array(np.full(len(each), error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return found.mapInArrow(run, SCHEMA)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))
