"""Table analytics.

Joins of users with their transfers aggregate the transfers per user first: the partial
aggregate collapses a user with a third of all rows before any shuffle, and the join then
sees one row per user on both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferlake.functions import money
from transferlake.schemas import LARGE_TRANSFER_THRESHOLD, UNKNOWN_STATUS
from transferlake.session import stored


def _sum_money(c, money_scale):
    return F.sum(money(c, money_scale))


def _as_double(c, money_scale):
    return c.cast("double") if money_scale is not None else c


def status_counts(good: DataFrame) -> DataFrame:
    """A2: COUNT(*) by status."""
    return good.groupBy("status").agg(F.count(F.lit(1)).alias("count"))


def large_usd(good: DataFrame, min_amount: float = 10000.0, currency: str = "USD") -> DataFrame:
    """Amount > min_amount AND currency = 'USD' (pushed to the scan on a table)."""
    return good.where((F.col("amount") > min_amount) & (F.col("currency") == currency))


def unknown_status(df: DataFrame) -> DataFrame:
    """Rows whose status is 'Unknown' (found in the DLQ; the good table has none)."""
    return df.where(F.col("status") == UNKNOWN_STATUS)


def large_transfer_alerts(events: DataFrame, threshold: float = LARGE_TRANSFER_THRESHOLD,
                          columns: tuple[str, ...] = ("tx_id", "receiver_id", "amount")) -> DataFrame:
    """Transfers above the threshold (batch or stream; stateless)."""
    return events.where(F.col("amount") > threshold).select(*columns)


def transfers_view(good: DataFrame) -> DataFrame:
    """The projecting view (5 of 7 columns)."""
    return good.select("tx_id", "amount", "currency", "status", "timestamp")


def table_preview(df: DataFrame, n: int = 20, order_by: str | None = "tx_id") -> DataFrame:
    """First n rows; ordered when ``order_by`` is given (TakeOrderedAndProject)."""
    return (df.orderBy(order_by) if order_by else df).limit(n)


def sorted_transfers(df: DataFrame, key: str = "sender_id", tiebreak: tuple[str, ...] = ("tx_id",)) -> DataFrame:
    """H1: global sort by ``key``. Range partitioning cannot split equal keys, so the sort key
    is extended by a unique tie-break: a sender with a third of all rows then spans several
    range partitions instead of one task."""
    return df.orderBy(key, *tiebreak)


def sender_avg_diff(good: DataFrame, money_scale: int | None = None) -> DataFrame:
    """Each transfer with its sender's average amount and the difference. Transfers
    without a sender are one group, as in a window over sender_id.

    Per-sender sums are a partial aggregate (a sender with a third of all rows is combined
    map-side), frozen as a table in the shared folder and joined back null-safely. Catalyst
    broadcasts that table if it is small; else it is an ordinary shuffle join, which AQE splits
    where one sender holds many rows (it can't split a join whose other side is an aggregate,
    nor a window)."""
    per = (good.groupBy(F.col("sender_id").alias("_sender"))
               .agg((_as_double(_sum_money("amount", money_scale), money_scale) / F.nullif(F.count("amount"), F.lit(0))).alias("user_avg_amount")))
    per = stored(per, "sender-averages")
    base = good.select("sender_id", "tx_id", "timestamp", "amount")
    joined = base.join(per, F.col("sender_id").eqNullSafe(F.col("_sender")), "left")
    return joined.select("sender_id", "tx_id", "timestamp", "amount", "user_avg_amount",
                         (F.col("amount") - F.col("user_avg_amount")).alias("diff_from_avg"))


def _per_user(transfers: DataFrame, money_scale, status: str | None = None, also: tuple[str, ...] = ()) -> DataFrame:
    t = transfers if status is None else transfers.where(F.col("status") == status)
    return t.groupBy("user_id", *also).agg(_sum_money("amount", money_scale).alias("_s"))


def user_totals(users: DataFrame, transfers: DataFrame, money_scale: int | None = None,
                status: str | None = None) -> DataFrame:
    """J2/A3 (and D7 with ``status``): SUM(amount) by user name over the inner join."""
    j = users.select("user_id", "name").join(_per_user(transfers, money_scale, status), "user_id")
    return j.groupBy("name").agg(_as_double(F.sum("_s"), money_scale).alias("total_amount"))


def user_totals_all(users: DataFrame, transfers: DataFrame, money_scale: int | None = None,
                    status: str | None = None) -> DataFrame:
    """Every user, 0 when there is no (matching) transfer. ``status`` is part of the join
    condition, so it does not drop users."""
    j = users.select("user_id", "name").join(_per_user(transfers, money_scale, status), "user_id", "left")
    total = F.coalesce(_as_double(F.sum("_s"), money_scale), F.lit(0.0))
    return j.groupBy("name").agg(total.alias("total_amount"))


def user_totals_having(users: DataFrame, transfers: DataFrame, min_total: float = 1000.0,
                       money_scale: int | None = None) -> DataFrame:
    """A4: HAVING SUM(amount) > min_total."""
    return user_totals(users, transfers, money_scale).where(F.col("total_amount") > min_total)


def user_currency_totals(users: DataFrame, transfers: DataFrame, currencies: DataFrame,
                         money_scale: int | None = None) -> DataFrame:
    """SUM(amount) by (name, currency_code) over users x transfers x currencies; the
    currency is the transfer's, so a user has a row for each currency."""
    j = (users.select("user_id", "name")
              .join(_per_user(transfers, money_scale, also=("currency_id",)), "user_id")
              .join(currencies.select("currency_id", "currency_code"), "currency_id"))
    return (j.groupBy("name", "currency_code")
             .agg(_as_double(F.sum("_s"), money_scale).alias("total_amount")))


def top_users(totals: DataFrame, k: int = 3) -> DataFrame:
    """H3: top k by total_amount; ties broken by name so the answer is deterministic."""
    return totals.orderBy(F.desc("total_amount"), F.asc("name")).limit(k)
