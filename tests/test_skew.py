"""Hot keys (one key with a third of all rows) through the join paths, with broadcasts off
and AQE skew thresholds lowered so the sort-merge joins must split the hot partition."""

import contextlib

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from transferlake.operators import analytics
from transferlake.operators.enrich import enrich_events, receiver_dim, snapshot_dimension
from transferlake.plans.views import Views
from tests.conftest import SF01

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def conf(spark, values):
    saved = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.fixture()
def hot_good(spark):
    good = Views(spark, SF01).good.repartition(8)      # AQE splits a partition by map task
    hot = F.pmod(F.xxhash64("tx_id"), F.lit(3)) == 0
    return good.withColumn("sender_id", F.when(hot, F.lit("HOT")).otherwise(F.col("sender_id"))) \
               .withColumn("receiver_id", F.when(hot, F.lit("R0")).otherwise(F.col("receiver_id")))


def executed(df) -> str:
    """Final adaptive plan: run the DataFrame's own execution, then read its plan."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_sender_average_under_skew(spark, hot_good):
    with conf(spark, SKEW_CONF):
        out = analytics.sender_avg_diff(hot_good)
        plan = executed(out)
        w = Window.partitionBy("sender_id")
        ref = hot_good.select("sender_id", "tx_id", "timestamp", "amount",
                              F.avg("amount").over(w).alias("user_avg_amount"))
        got = out.select("tx_id", F.round("user_avg_amount", 6).alias("a"))
        exp = ref.select("tx_id", F.round("user_avg_amount", 6).alias("a"))
        assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
        assert out.count() == hot_good.count()
    # the averages are a table of their own, so the hot sender's side of the join is split
    assert "SortMergeJoin(skew=true)" in plan


def test_enrichment_left_join_under_skew(spark, hot_good, tmp_dir):
    v = Views(spark, SF01)
    events = v.events.repartition(8).withColumn("receiver_id", F.when(F.col("tx_id") % 3 == 0, F.lit("R0"))
                                 .otherwise(F.col("receiver_id")))
    dim = snapshot_dimension(receiver_dim(hot_good), f"{tmp_dir}/dim")
    with conf(spark, SKEW_CONF):
        out = enrich_events(events, dim)
        plan = executed(out)
        got = out.select("tx_id", "currency")
    exp = enrich_events(events, dim, broadcast_dim=True).select("tx_id", "currency")
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
    assert "SortMergeJoin(skew=true)" in plan


def test_user_totals_preaggregate_hot_user(spark):
    v = Views(spark, SF01)
    transfers = v.transfers.withColumn("user_id", F.when(F.xxhash64("amount") % 3 == 0, F.lit(1))
                                       .otherwise(F.col("user_id")))
    with conf(spark, SKEW_CONF):
        out = analytics.user_totals(v.users, transfers, money_scale=2)
        got = {r.name: r.total_amount for r in out.collect()}
    exp = (v.users.join(transfers, "user_id").groupBy("name")
             .agg(F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("t")).collect())
    assert got == {r.name: r.t for r in exp}
