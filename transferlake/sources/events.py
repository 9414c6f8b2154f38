"""Topic payloads (S9-S11): JSON encode/decode of transfer events and the stream source."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transferlake.schemas import EVENT_DDL


def payload(fields: list[str], keep_nulls: bool = True):
    """JSON text of the given columns; NULL fields are written as null (as json.dumps does)."""
    opts = {"ignoreNullFields": "false"} if keep_nulls else {}
    return F.to_json(F.struct(*fields), opts)


def encode_events(df: DataFrame, fields: list[str], keep_nulls: bool = True) -> DataFrame:
    """One JSON text per row in ``value``."""
    return df.select(payload(fields, keep_nulls).alias("value"))


def decode_events(records: DataFrame, schema: str = EVENT_DDL, value_col: str = "value",
                  drop_undecodable: bool = True) -> DataFrame:
    """Binary or text payload to flat typed columns.

    Malformed JSON gives an all-NULL struct; an INT overflow gives NULL in that field only.
    ``drop_undecodable`` skips empty and unparsable messages (all fields NULL)."""
    data = F.from_json(F.col(value_col).cast("string"), schema)
    out = records.select(data.alias("data"))
    if drop_undecodable:
        fields = [f.strip().split(" ")[0] for f in schema.split(",")]
        present = [F.col("data").getField(f).isNotNull() for f in fields]
        out = out.where(functools.reduce(lambda a, b: a | b, present))
    return out.select("data.*")


def kafka_options(options: dict, max_per_trigger: int | None = None) -> dict:
    """Kafka source options (I8, I12): start from the earliest offsets, tolerate lost offsets,
    and cap each micro-batch at ``max_per_trigger`` offsets; caller options win."""
    opts = {"startingOffsets": "earliest", "failOnDataLoss": "false"}
    if max_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_per_trigger)
    opts.update(options)
    return opts


def read_event_stream(spark: SparkSession, source: str = "files", *, path: str | None = None,
                      options: dict | None = None, max_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``value`` records.

    ``source="files"``: text files under ``path`` (one JSON object per line), taken in
    modification-time order, ``max_per_trigger`` files per micro-batch.
    ``source="kafka"``: caller supplies connection options (bootstrap servers, topic);
    ``max_per_trigger`` maps to ``maxOffsetsPerTrigger``. Needs the Kafka connector jar.
    """
    opts = dict(options or {})
    if source == "files":
        reader = spark.readStream.format("text")
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        return reader.options(**opts).load(path)
    if source == "kafka":
        return (spark.readStream.format("kafka").options(**kafka_options(opts, max_per_trigger))
                     .load().select("value"))
    raise ValueError(f"unknown source {source!r}")


def write_events(published: DataFrame, fmt: str = "text", path: str | None = None,
                 options: dict | None = None, mode: str = "append") -> None:
    """Publish ``value`` payloads (S11). ``fmt='text'``: one JSON object per line under
    ``path``. ``fmt='kafka'``: caller options (``kafka.bootstrap.servers``, ``topic``); no key
    is sent, so the topic's partitioner spreads events (needs the Kafka connector jar)."""
    out = published.select("value")
    w = out.write.mode(mode).options(**(options or {}))
    if fmt == "text":
        w.text(path)
    else:
        w.format(fmt).save()
