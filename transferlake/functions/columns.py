"""Column expressions. All are built-in Spark expressions (JVM side, whole-stage codegen);
none raises under ANSI mode on dirty strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from transferlake.schemas import STATUS_SENTINELS, UNKNOWN_STATUS

def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_id(c) -> Column:
    """Remove every whitespace character (ends and inside). One expression for batch and stream."""
    return F.regexp_replace(_c(c), r"\s+", "")


def strip_ws(c) -> Column:
    """Strip leading/trailing whitespace of any kind (tabs, newlines), like Python's str.strip."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def parse_amount(c) -> Column:
    """Decimal comma to point, then parse; NULL when unparsable (so '1,234.56' is NULL)."""
    return F.replace(F.trim(_c(c)), F.lit(","), F.lit(".")).try_cast("double")


def lenient_amount(c, default: float | None = 0.0) -> Column:
    """Publisher rule: comma to point, strip blanks and quotes; bad or missing gives ``default``
    (None keeps NULL)."""
    s = F.replace(_c(c).cast("string"), F.lit(","), F.lit("."))
    s = F.regexp_replace(strip_ws(s), r'^"+|"+$', "")
    parsed = s.try_cast("double")
    return parsed if default is None else F.coalesce(parsed, F.lit(default))


def lenient_long(c) -> Column:
    """Integer parse like Python's int(): blanks around allowed, '12.0' or '' gives NULL."""
    s = strip_ws(_c(c).cast("string"))
    return F.when(s.rlike(r"^[+-]?[0-9]+$"), s.try_cast("bigint"))


def normalise_status(c) -> Column:
    """Trim, then map the sentinel spellings to 'Unknown'. NULL stays NULL."""
    s = F.trim(_c(c))
    return F.when(s.isin(*STATUS_SENTINELS), F.lit(UNKNOWN_STATUS)).otherwise(s)


def epoch_to_instant(c) -> Column:
    """Epoch seconds to TIMESTAMP; independent of the session time zone. NULL stays NULL."""
    return F.timestamp_seconds(_c(c))


def epoch_seconds_of_ntz(c) -> Column:
    """Whole epoch seconds of a TIMESTAMP_NTZ read as UTC wall time. ``unix_timestamp`` of an
    NTZ value uses no zone (``timestampdiff`` would cast through the session zone and be an
    hour off around daylight-saving changes)."""
    return F.unix_timestamp(_c(c))


def instant_to_ntz(c) -> Column:
    """TIMESTAMP to its UTC wall time as TIMESTAMP_NTZ, independent of the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(c)), _epoch_ntz())


def ntz_to_instant(c) -> Column:
    """TIMESTAMP_NTZ holding UTC wall time to TIMESTAMP, independent of the session zone."""
    frac_us = (F.date_part(F.lit("SECOND"), _c(c)) * 1_000_000).cast("bigint") % 1_000_000
    return F.timestamp_micros(F.unix_timestamp(_c(c)) * 1_000_000 + frac_us)


def money(c, scale: int | None) -> Column:
    """Value used for summing money: DOUBLE as is, or exact DECIMAL(28, scale) when a scale is
    given (amounts with more decimals are rounded to it). The cleaning step rejects amounts the
    type can't hold; from other inputs such an amount counts as NULL, so one can't stop a sum."""
    if scale is None:
        return _c(c)
    return _c(c).try_cast(f"decimal(28,{scale})")
