"""Landing CSV files (S1-S4): one glob read with a declared schema; provenance from the
hidden ``_metadata`` column instead of a driver-side file listing."""

from __future__ import annotations

import csv
import functools
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transferlake.schemas import LANDING_DDL

LISTING_TASKS = 64
HEADER_FILES = 256          # files whose first line one task reads
HEADER_BYTES = 1 << 14
_SOURCE_TYPES = [("source_file", "string"), ("source_block", "bigint"), ("source_length", "bigint"), ("source_row", "bigint")]


def source_columns() -> list:
    """Where a row of a scan comes from (made per scan: row ids belong to it)."""
    return [F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("source_block"),
            F.col("_metadata.file_block_length").alias("source_length"), F.monotonically_increasing_id().alias("source_row")]


def _fields(ddl: str) -> list[tuple[str, str]]:
    return [tuple(f.strip().split(" ", 1)) for f in ddl.split(",")]


def read_landing(spark: SparkSession, path: str | list[str], schema: str = LANDING_DDL, *,
                 by_header: bool = False, validate_header: bool = False,
                 with_source: bool = False, ignore_missing: bool = True) -> DataFrame:
    """Read every CSV under ``path`` (a folder, glob or list of files) in one scan.

    ``by_header=False``: columns bind by position to the declared schema (a bad LONG or an
    empty field becomes NULL; permissive). ``validate_header`` makes Spark check each file's
    header against the declared names instead of ignoring it. ``by_header=True``: columns
    bind by each file's own header, whatever its width and order, and are cast with
    ``try_cast``. ``with_source`` adds the file of every row (``source_file``), the start and
    length of its split (``source_block``, ``source_length``) and its number in the scan
    (``source_row``, rising by one inside a split); file, block and row give the order of rows
    across files.
    """
    reader = (spark.read.option("header", True).option("mode", "PERMISSIVE")
              .option("ignoreMissingFiles", ignore_missing))
    names = [n for n, _ in _fields(schema)]
    if by_header:
        df = _bind_by_header(spark, path, schema, ignore_missing)
    else:
        df = reader.schema(schema).option("enforceSchema", not validate_header).csv(path)
        df = df.select(*names, *(source_columns() if with_source else []))
    return df.select(*names, *([n for n, _ in _SOURCE_TYPES] if with_source else []))


def landing_files(spark: SparkSession, path: str) -> DataFrame:
    """The landing files, one row each: source_file, length, modified. Only the listing is
    read, in a few tasks however many files there are."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("_metadata.file_path").alias("source_file"), "length", F.col("modificationTime").alias("modified")).coalesce(LISTING_TASKS)


def new_files(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """Landing files that are not in a manifest of loaded ones (source_file, length, modified). A
    file that was written again counts as new."""
    return landing_files(spark, path).join(manifest, ["source_file", "length", "modified"], "left_anti")


def headers(spark: SparkSession, files: list[str], ignore_missing: bool = True) -> dict[tuple, list[str]]:
    """Files by header (names as they stand, in order). Every file is opened once, through pyarrow,
    and read to the end of its first line, ``HEADER_FILES`` files a task; files without any line are left out. The driver holds the
    paths, as it does for any scan of them."""
    def first_line(uri: str) -> str:
        from pyarrow import fs
        store, at = fs.FileSystem.from_uri(uri)
        with store.open_input_stream(at, compression="detect", buffer_size=HEADER_BYTES) as stream:
            got = b""
            while b"\n" not in got and (more := stream.read(HEADER_BYTES)):
                got += more
        return got.split(b"\n", 1)[0].decode("utf-8-sig", "replace").rstrip("\r")

    def run(batches):
        for batch in batches:
            found = []
            for uri in batch.column(0).to_pylist():
                try:
                    line = first_line(uri)
                except FileNotFoundError:
                    if not ignore_missing:
                        raise
                    line = ""
                found.append([n.strip() for n in next(csv.reader([line]), [])])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], ["source_file", "names"])
    if not files:
        return {}
    listed = spark.createDataFrame([(f,) for f in files], "source_file string").repartition(-(-len(files) // HEADER_FILES))
    out: dict[tuple, list[str]] = {}
    for r in sorted(listed.mapInArrow(run, "source_file string, names array<string>").collect()):
        if r["names"]:
            out.setdefault(tuple(r["names"]), []).append(r["source_file"])
    return out


def _bind_by_header(spark: SparkSession, path: str | list[str], schema: str, ignore_missing: bool) -> DataFrame:
    """Bind columns by every file's own header (Spark's reader would take the names of the first
    file and read all others by position).

    Files with one header are one scan with that header's columns, of which only the declared
    ones are parsed; scans of different headers (usually one or two) are put together. A
    name that a header lacks is NULL there, of a name it has twice the first counts."""
    fields = _fields(schema)
    every = spark.read.option("ignoreMissingFiles", ignore_missing).text(path).inputFiles() if path else []
    parts = []
    for names, files in headers(spark, every, ignore_missing).items():
        raw = (spark.read.schema(", ".join(f"_c{i} STRING" for i in range(len(names)))).option("header", True)
               .option("mode", "PERMISSIVE").option("ignoreMissingFiles", ignore_missing).csv([unquote(f) for f in files]))
        bound = [(F.col(f"_c{names.index(n)}") if n in names else F.lit(None)).try_cast(t).alias(n) for n, t in fields]
        parts.append(raw.select(*bound, *source_columns()))
    if not parts:
        return spark.createDataFrame([], schema).select("*", *[F.lit(None).cast(t).alias(n) for n, t in _SOURCE_TYPES])
    return functools.reduce(DataFrame.unionByName, parts)


def write_landing(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write rows as header CSV without touching blanks (the writer trims them by default)."""
    (df.write.mode(mode).option("header", True)
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))


def files_by_source(df: DataFrame) -> DataFrame:
    """Row count per landing file (needs ``with_source=True``)."""
    return df.groupBy("source_file").agg(F.count(F.lit(1)).alias("n_rows"))
