"""Randomised checks: exact good/DLQ split, and sliding stats against brute force."""

from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from transferlake.operators import cleaning, stats
from transferlake.operators.enrich import with_event_time
from transferlake.schemas import LANDING_DDL

amounts = st.one_of(st.none(), st.sampled_from(["", " ", "0", "-1", "12,5", "1,234.56", "NaN", "abc", "7.25", " 3 "]),
                    st.floats(allow_nan=False, allow_infinity=False, width=32).map(str))
statuses = st.one_of(st.none(), st.sampled_from(["", "  ", "N/A", "NULL", " null", "success", " failed ", "pending"]))
epochs = st.one_of(st.none(), st.integers(min_value=-10, max_value=2_000_000_000))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(amounts, statuses, epochs), min_size=1, max_size=40))
def test_split_is_exact(spark, rows):
    raw = spark.createDataFrame([(str(i), " a ", " b ", a, "EUR", s, e) for i, (a, s, e) in enumerate(rows)],
                                LANDING_DDL)
    tagged = cleaning.tag_transfers(cleaning.clean_transfers(raw))
    good = {r.tx_id for r in cleaning.good_rows(tagged).collect()}
    dlq = {r.tx_id: r.reject_reasons for r in cleaning.dlq_rows(tagged).collect()}
    assert good.isdisjoint(dlq) and len(good) + len(dlq) == len(rows)
    assert all(reasons for reasons in dlq.values())


events = st.lists(st.tuples(st.integers(0, 7200), st.sampled_from(["a", "b"]), st.sampled_from(["USD", None]),
                            st.integers(1, 999), st.one_of(st.none(), st.integers(0, 100))),
                  min_size=1, max_size=60)


def brute(rows, window_s=600, slide_s=60):
    out = defaultdict(lambda: [0, 0])
    for ts, status, cur, cents, tx in rows:
        first = (ts // slide_s) * slide_s
        for start in range(first - window_s + slide_s, first + 1, slide_s):
            key = (start, start + window_s, status, cur)
            out[key][0] += cents
            out[key][1] += tx is not None
    return {k: (v[0], v[1]) for k, v in out.items()}


@settings(max_examples=10, deadline=None)
@given(events)
def test_sliding_strategies_equal_brute_force(spark, rows):
    base = 1_704_067_200
    df = spark.createDataFrame([(tx, s, c / 100.0, base + ts, cur) for ts, s, cur, c, tx in rows],
                               "tx_id int, status string, amount double, timestamp long, currency string")
    df = with_event_time(df)
    expected = {(base + a, base + b, s, c): v for (a, b, s, c), v in brute(rows).items()}
    for strategy in ("preagg", "window"):
        got = stats.sliding_stats(df, money_scale=2, strategy=strategy).select(
            F.unix_timestamp(F.col("window_start")).alias("a"), F.unix_timestamp(F.col("window_end")).alias("b"),
            "status", "currency", F.round(F.col("total_sum") * 100).cast("long").alias("cents"), "tx_count").collect()
        assert {(r.a, r.b, r.status, r.currency): (r.cents, r.tx_count) for r in got} == expected, strategy


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 20), min_size=1, max_size=80), st.integers(1, 6))
def test_running_number_is_a_dense_order(spark, keys, parts):
    from transferlake.operators.ordering import running_number
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int")
    rows = sorted(running_number(df, ["k"], "seq", num_partitions=parts).collect(), key=lambda r: r.seq)
    assert [r.seq for r in rows] == list(range(1, len(keys) + 1))
    assert [r.k for r in rows] == sorted(keys)
