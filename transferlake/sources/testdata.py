"""Views over the shared test tables. Every view is a Spark derivation of the
given parquet tables, so its work grows with them.

V1 raw_transfers   dirty landing rows made from ``orders``
V4 tx_events       decoded topic events made from ``events``
V6 users / transfers / currencies  made from ``customer`` / ``orders`` / ``nation`` + ``region``
(V2, V3 and V5 are produced by the library operators themselves.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transferlake.functions import epoch_seconds_of_ntz


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cases(key, mapping: dict, default):
    expr = None
    for k, v in mapping.items():
        v = v if hasattr(v, "alias") else F.lit(v)
        expr = F.when(key == k, v) if expr is None else expr.when(key == k, v)
    return expr.otherwise(default if hasattr(default, "alias") else F.lit(default))


def raw_transfers(orders: DataFrame, keep: list = ()) -> DataFrame:
    """V1: landing rows (all strings but the epoch) with the dirt the cleaning rules handle.
    ``keep``: columns of the scan that are passed on."""
    k = F.col("o_orderkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    whole = F.floor(cents / 100).cast("bigint").cast("string")
    frac = F.lpad((cents % 100).cast("string"), 2, "0")
    plain = F.concat(whole, F.lit("."), frac)
    amount = _cases(k % 11, {
        0: F.concat(F.lit("-"), plain),
        1: F.lit(None).cast("string"),
        2: F.concat(whole, F.lit(","), frac),
        3: "1,234.56",
        4: "0",
        5: "0,5",
        6: "25000000",
    }, plain)
    currency = _cases(F.col("o_custkey") % 3, {0: "USD", 1: "EUR"}, "RUB")
    status = _cases(k % 13, {
        0: "N/A", 1: " NULL ", 2: "  ", 3: F.lit(None).cast("string"), 4: " null",
        5: "failed", 6: " pending ",
    }, " success ")
    epoch = _cases(k % 17, {0: F.lit(None).cast("bigint"), 1: F.lit(0).cast("bigint"),
                            2: F.lit(-5).cast("bigint")},
                   epoch_seconds_of_ntz(F.col("o_orderdate")))
    return orders.select(
        k.cast("string").alias("tx_id"),
        F.concat(F.lit(" C "), F.col("o_custkey").cast("string"), F.lit(" ")).alias("sender_id"),
        F.concat(F.lit("R"), (F.col("o_custkey") % 50).cast("string"), F.lit(" ")).alias("receiver_id"),
        amount.alias("amount"),
        currency.alias("currency"),
        status.alias("status"),
        epoch.alias("timestamp"),
        *keep,
    )


def tx_events(events: DataFrame) -> DataFrame:
    """V4: decoded topic events (topic payload columns) made from ``events``."""
    k = F.from_json(F.col("props"), "k INT").getField("k")
    return events.select(
        F.col("event_id").cast("bigint").alias("tx_id"),
        F.col("event_type").alias("status"),
        F.col("value").alias("amount"),
        epoch_seconds_of_ntz(F.col("ts")).alias("timestamp"),
        F.concat(F.lit("R"), (F.col("user_id") % 60).cast("string")).alias("receiver_id"),
        F.when(k % 4 == 0, F.lit("USD")).alias("currency"),
    )


def users(customer: DataFrame) -> DataFrame:
    """V6 users(user_id, name)."""
    return customer.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))


def user_transfers(orders: DataFrame) -> DataFrame:
    """V6 transfers(user_id, amount, status, currency_id); 'success' is order status 'F', and a
    transfer's currency is one of the 25 countries' by its order key, so users have several."""
    return orders.select(F.col("o_custkey").alias("user_id"), F.col("o_totalprice").alias("amount"),
                         F.col("o_orderstatus").alias("status"),
                         F.pmod(F.col("o_orderkey"), F.lit(25)).cast("int").alias("currency_id"))


def second_month(events: DataFrame) -> DataFrame:
    """V4 and a copy of it 31 days later, with ids beyond the range of INT."""
    later = events.withColumn("tx_id", F.col("tx_id") + F.lit(10_000_000_000)) \
                  .withColumn("timestamp", F.col("timestamp") + F.lit(31 * 86_400))
    return events.unionByName(later)


def with_hot_receiver(events: DataFrame) -> DataFrame:
    """V4 with a third of the events sent to one receiver."""
    return events.withColumn("receiver_id", F.when(F.pmod(F.col("tx_id"), F.lit(3)) == 0, F.lit("R7")).otherwise(F.col("receiver_id")))


def without_some_senders(good: DataFrame) -> DataFrame:
    """V3 with a third of the senders unknown."""
    return good.withColumn("sender_id", F.when(F.pmod(F.col("tx_id").cast("bigint"), F.lit(3)) != 0, F.col("sender_id")))


def currencies(nation: DataFrame, region: DataFrame) -> DataFrame:
    """V6 currencies(currency_id, currency_code): region name per nation."""
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("currency_id"), F.col("r_name").alias("currency_code"))
