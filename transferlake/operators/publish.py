"""Event publishing (S11, C13-C16, H6): landing rows to numbered JSON events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferlake.functions import lenient_amount, lenient_long, strip_ws
from transferlake.operators.ordering import number_in_place, running_number
from transferlake.sources.events import payload
from transferlake.schemas import PUBLISHED_FIELDS


def event_fields(raw: DataFrame, on_bad: str = "zero", keep: list[str] = ()) -> DataFrame:
    """Publisher's per-row rules as column expressions: amount comma->point, blanks and quotes
    stripped, bad -> 0.0; timestamp parsed like int() (bad/blank -> NULL); receiver stripped;
    status passed through as is. All columns are published (currency and sender included).
    ``on_bad``: 'zero' publishes a bad amount as 0.0 (the publisher's rule), 'null' as null
    (the cleaning job's rule). ``keep``: columns passed on for the order."""
    if on_bad not in ("zero", "null"):
        raise ValueError(on_bad)
    amount = lenient_amount("amount", 0.0 if on_bad == "zero" else None)
    return raw.select(
        F.col("status"),
        amount.alias("amount"),
        lenient_long("timestamp").alias("timestamp"),
        strip_ws("receiver_id").alias("receiver_id"),
        F.col("currency"),
        F.col("sender_id"),
        *keep,
    )


SPLIT = ["source_file", "source_block", "source_length"]


def publish_events(raw: DataFrame, order_by: list | None = None, cap: int | None = None,
                   num_partitions: int | None = None, on_bad: str = "zero") -> DataFrame:
    """Numbered events: ``tx_id`` is the running number 1..N, ``value`` the JSON payload (nulls
    kept).

    Without ``order_by`` the order is that of the landing files, by path, and ``raw`` carries
    the source columns of its scan (``SPLIT`` and ``source_row``): events are numbered in place,
    without a shuffle.
    ``order_by`` names any other order, which takes a range sort. ``cap`` keeps events 1..cap: in
    file order only the splits that hold them are joined, in another order it filters by number."""
    if order_by is None:
        keys = [*SPLIT, "source_row"]
        numbered = number_in_place(event_fields(raw, on_bad, keys), SPLIT, "source_row", "tx_id", cap=cap)
        return numbered.select("tx_id", payload(PUBLISHED_FIELDS).alias("value"))
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    keyed = raw.select("*", *[c.alias(f"_order{i}") for i, c in enumerate(order_cols)])
    keys = [f"_order{i}" for i in range(len(order_cols))]
    numbered = running_number(event_fields(keyed, on_bad, keys), keys, "tx_id", num_partitions)
    if cap is not None:
        numbered = numbered.where(F.col("tx_id") <= cap)
    return numbered.select("tx_id", payload(PUBLISHED_FIELDS).alias("value"))


def capped_files(read, files: list[tuple[str, int]], cap: int, first_bytes: int = 128 << 20) -> list[str]:
    """The first files that hold ``cap`` rows, and perhaps some more. ``files`` are (path, bytes) in
    publishing order and ``read(paths)`` scans some of them. Files are counted in steps, each of
    twice the bytes of the one before, so that about twice what the cap needs is opened, whatever lies
    behind it."""
    at, wanted, rows = 0, first_bytes, 0
    while at < len(files) and rows < cap:
        stop, size = at, 0
        while stop < len(files) and (stop == at or size + files[stop][1] <= wanted):
            size += files[stop][1]
            stop += 1
        rows += read([f for f, _ in files[at:stop]]).count()
        at, wanted = stop, 2 * max(wanted, size)
    return [f for f, _ in files[:at]]
