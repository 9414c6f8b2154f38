"""Session helpers.

Library operators never create sessions; these helpers are for scripts, tests and the
benchmark. Shared scratch space is always taken from the cluster's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", app: str = "transferlake",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_SCRATCH_KEY = "spark.transferlake.scratchDir"
NO_SHARED_DIR = "set spark.checkpoint.dir to a folder that the driver and all executors share"


def scratch_for(master: str) -> str:
    """A private scratch folder for a local master; an error for any other."""
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(NO_SHARED_DIR)
    return tempfile.mkdtemp(prefix="transferlake-ckpt-")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session names none and its master is local (tests, a bare local session) a
    private folder is made, registered as the SparkContext's checkpoint dir
    (``spark.checkpoint.dir`` itself cannot be changed at runtime) and remembered under a
    library key for later calls. On any other master a missing setting is an error: a folder of
    the driver's machine would leave every executor with files of its own."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_SCRATCH_KEY, None)
    try:
        sc_dir = spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001  (Spark Connect: the server reads spark.checkpoint.dir)
        if not path:
            raise RuntimeError(NO_SHARED_DIR) from None
        return path
    if not path:
        path = sc_dir or scratch_for(spark.sparkContext.master)
        spark.conf.set(_SCRATCH_KEY, path)
    if sc_dir is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def shared_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A folder under the shared checkpoint dir (visible to every executor)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    sub = list(parts)
    if unique:
        sub.append(uuid.uuid4().hex[:12])
    return "/".join([base, "transferlake", *sub])


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet to the shared folder and read back: later uses see the
    same rows, whatever executors are lost."""
    path = shared_dir(df.sparkSession, "stored", name, unique=True)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``stored``, and the number of rows, counted as they are written."""
    seen = Observation()
    out = stored(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    return out, int(seen.get["n"])


def read_optional(spark: SparkSession, path: str, schema) -> DataFrame:
    """A Parquet table that may not have been written yet: no rows then."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def local_path(path: str) -> str | None:
    """Plain filesystem path for a ``file:`` or bare path, else None (remote store)."""
    if path.startswith("file:"):
        return path[len("file:"):]
    if "://" in path:
        return None
    return path if os.path.isabs(path) else None
