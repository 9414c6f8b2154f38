"""Batch clean + quarantine.

Every input row is parsed once, tagged with its reject reasons, and routed: no reasons means
good, anything else goes to the dead-letter (DLQ) table. The two outputs partition the input
exactly (good + DLQ = input), unlike a pair of independent filters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferlake.functions import (epoch_to_instant, normalise_id, normalise_status,
                                    ntz_to_instant, parse_amount)
from transferlake.schemas import (AMOUNT_BOUND, GOOD_COLUMNS, ORIGINAL_EFFECTIVE_SENTINELS, REJECT_REASONS,
                                  UNKNOWN_STATUS)

def _epoch() -> F.Column:
    return F.timestamp_seconds(F.lit(0))


def clean_transfers(raw: DataFrame) -> DataFrame:
    """V2: typed, normalised rows plus the raw values the DLQ keeps.

    ids lose all whitespace; amount takes a decimal comma and is NULL when unparsable;
    status is trimmed and its sentinels become 'Unknown'; epoch seconds become a TIMESTAMP.
    String columns are trimmed before casting, typed columns are never turned into strings."""
    return raw.select(
        F.trim("tx_id").alias("tx_id"),
        normalise_id("sender_id").alias("sender_id"),
        normalise_id("receiver_id").alias("receiver_id"),
        parse_amount("amount").alias("amount"),
        F.trim("currency").alias("currency"),
        normalise_status("status").alias("status"),
        epoch_to_instant("timestamp").alias("timestamp"),
        F.col("amount").alias("raw_amount"),
        F.col("status").alias("raw_status"),
        F.col("timestamp").alias("raw_epoch"),
    )


def reject_reasons(df: DataFrame, max_epoch: int | None = None) -> F.Column:
    """ARRAY<STRING> of the rules a cleaned row breaks (empty for a good row). ``max_epoch``
    (off by default) also rejects timestamps after that epoch second, e.g. milliseconds sent
    as seconds."""
    amount, status, ts = F.col("amount"), F.col("status"), F.col("timestamp")
    raw_missing = F.col("raw_amount").isNull() | (F.trim(F.col("raw_amount")) == "")
    rules = {
        "amount_missing": raw_missing,
        "amount_unparsable": ~raw_missing & amount.isNull(),
        "amount_not_finite": F.isnan(amount) | (F.abs(amount) == float("inf")),
        "amount_not_positive": amount <= 0,
        "amount_above_bound": (amount >= AMOUNT_BOUND) & (amount < float("inf")),
        "status_missing": status.isNull(),
        "status_unknown": status == UNKNOWN_STATUS,
        "timestamp_missing": ts.isNull(),
        "timestamp_not_after_epoch": ts <= _epoch(),
    }
    if max_epoch is not None:
        rules["timestamp_after_bound"] = ts > F.timestamp_seconds(F.lit(max_epoch))
    ordered = [(name, rules[name]) for name in REJECT_REASONS if name in rules]
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in ordered]))


def good_predicate(max_epoch: int | None = None) -> F.Column:
    """D1 on cleaned columns: a positive finite amount, a known status, a time after the epoch
    (and not after ``max_epoch`` when given). NaN and infinity fail ``< AMOUNT_BOUND``; NULLs fail
    every comparison."""
    amount = F.col("amount")
    ok = ((amount > 0) & (amount < AMOUNT_BOUND)
          & F.col("status").isNotNull() & (F.col("status") != UNKNOWN_STATUS)
          & (F.col("timestamp") > _epoch()))
    if max_epoch is not None:
        ok = ok & (F.col("timestamp") <= F.timestamp_seconds(F.lit(max_epoch)))
    return F.coalesce(ok, F.lit(False))


def tag_transfers(clean: DataFrame, max_epoch: int | None = None) -> DataFrame:
    """Adds ``is_good``. Exactly the rows with no reject reason are good (tested), but the
    flag is the plain D1 predicate: when the optimizer pushes the route filter below the
    parsing projection it inlines the parse expressions once per reference, so the route test
    should reference them as few times as possible. Reasons are computed on DLQ rows only."""
    return clean.withColumn("is_good", good_predicate(max_epoch))


def good_rows(tagged: DataFrame) -> DataFrame:
    """D1 + C9: the good table's typed projection."""
    return tagged.where(F.col("is_good")).select(*GOOD_COLUMNS)


def dlq_rows(tagged: DataFrame, stamp: bool = True, max_epoch: int | None = None) -> DataFrame:
    """D2 as the exact complement of D1, typed, with raw values, reasons and a processing stamp.
    ``max_epoch`` must be the bound ``tagged`` was tagged with."""
    bad = tagged.where(~F.col("is_good"))
    out = bad.select(*GOOD_COLUMNS, "raw_amount", "raw_status", "raw_epoch",
                     reject_reasons(bad, max_epoch).alias("reject_reasons"))
    if stamp:
        out = out.withColumn("dlq_processed_at", F.current_timestamp())
    return out


def split_transfers(raw: DataFrame, max_epoch: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Both outputs from one tagged frame (callers that write both should persist or
    checkpoint ``tag_transfers(clean_transfers(raw))`` once and pass it to good_rows/dlq_rows)."""
    tagged = tag_transfers(clean_transfers(raw), max_epoch)
    return good_rows(tagged), dlq_rows(tagged, max_epoch=max_epoch)


def good_transfers(raw: DataFrame) -> DataFrame:
    return good_rows(tag_transfers(clean_transfers(raw)))


def dlq_transfers(raw: DataFrame, stamp: bool = True) -> DataFrame:
    return dlq_rows(tag_transfers(clean_transfers(raw)), stamp=stamp)


def fill_missing_timestamp(clean: DataFrame, fill: str = "1970-01-01 00:00:00") -> DataFrame:
    """Missing timestamp becomes a fixed instant, ``fill`` read as UTC (the reference
    fills with the epoch)."""
    fixed = ntz_to_instant(F.lit(fill).cast("timestamp_ntz"))
    return clean.withColumn("timestamp", F.coalesce(F.col("timestamp"), fixed))


def reject_summary(dlq: DataFrame) -> DataFrame:
    """Rows per reject reason (a row with two reasons counts under both)."""
    return (dlq.select(F.explode("reject_reasons").alias("reason"))
               .groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows")))


def reference_routes(clean: DataFrame) -> DataFrame:
    """Audit: rows whose route under the reference's own two filters differs from ours.

    The reference trims first and only then replaces sentinels, so ' null' survives as a
    status; it fills a missing timestamp with the epoch, and its filters do not partition the
    input, so some rows reach neither table ('lost')."""
    ref_status = F.trim(F.col("raw_status"))
    ref_status = F.when(ref_status.isin(*ORIGINAL_EFFECTIVE_SENTINELS), F.lit(UNKNOWN_STATUS)).otherwise(ref_status)
    ts = F.coalesce(F.col("timestamp"), _epoch())
    amount = F.col("amount")
    ref_good = ((amount > 0) & ref_status.isNotNull() & (ref_status != UNKNOWN_STATUS) & (ts > _epoch()))
    ref_dlq = ((amount < 0) | amount.isNull() | ref_status.isNull() | (ref_status == UNKNOWN_STATUS)
               | (ts < _epoch()) | ts.isNull())
    ref_route = (F.when(F.coalesce(ref_good, F.lit(False)), F.lit("good"))
                  .when(F.coalesce(ref_dlq, F.lit(False)), F.lit("dlq")).otherwise(F.lit("lost")))
    tagged = tag_transfers(clean)
    ours = F.when(F.col("is_good"), F.lit("good")).otherwise(F.lit("dlq"))
    return (tagged.select("tx_id", "raw_amount", "raw_status", "raw_epoch",
                          ref_route.alias("reference_route"), ours.alias("our_route"))
                  .where(F.col("reference_route") != F.col("our_route")))


def dedupe_transfers(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """A5: one row per key, the first by ``order_by`` (deterministic).

    Expressed as ``min_by`` over a struct, so it aggregates partially before the shuffle and a
    hot key never gathers its rows in one task."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(*order_by)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*df.columns)
