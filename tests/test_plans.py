"""Physical-plan properties the operators are designed for."""

from pyspark.sql import functions as F

from transferlake.operators import analytics, stats
from transferlake.operators.enrich import enrich_events
from transferlake.plans.views import Views
from tests.conftest import SF01


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_dimension_is_broadcast(spark):
    v = Views(spark, SF01)
    p = plan(v.enriched)
    assert "BroadcastHashJoin" in p and "LeftOuter" in p


def test_forced_broadcast_and_salted_join(spark):
    v = Views(spark, SF01)
    assert "BroadcastExchange" in plan(enrich_events(v.events, v.dim, broadcast_dim=True))
    salted = plan(enrich_events(v.events, v.dim, broadcast_dim=False, salt_buckets=4))
    assert "_salt" in salted


def test_sliding_preaggregates_before_expanding(spark):
    v = Views(spark, SF01)
    p = plan(stats.sliding_stats(v.enriched))
    # the explode of window offsets sits above the first (per-minute) aggregate
    generate_at = p.index("Generate")
    assert p.count("HashAggregate") >= 4
    assert p.index("HashAggregate", generate_at) > generate_at
    assert "Expand" not in p


def test_sender_average_has_no_window(spark):
    p = plan(analytics.sender_avg_diff(Views(spark, SF01).good))
    assert "Window" not in p


def test_user_totals_aggregate_before_join(spark):
    v = Views(spark, SF01)
    df = analytics.user_totals(v.users, v.transfers)
    p = df._jdf.queryExecution().optimizedPlan().toString()
    # an Aggregate below the Join: transfers are summed per user first
    join_at = p.index("Join")
    assert "Aggregate" in p[join_at:]


def test_sort_has_tiebreak(spark):
    p = plan(analytics.sorted_transfers(Views(spark, SF01).good))
    assert "rangepartitioning(sender_id" in p and "tx_id" in p.split("rangepartitioning(")[1].split(")")[0]


def test_filters_reach_parquet_scan(spark):
    p = plan(analytics.large_transfer_alerts(Views(spark, SF01).events.withColumn("amount", F.col("amount")), 200.0))
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,200.0)]" in p
