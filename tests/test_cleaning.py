"""Dirty-row fixture (one row per rule) and the split invariants."""

import pytest
from pyspark.sql import functions as F

from transferlake.operators import cleaning
from transferlake.plans.views import Views
from transferlake.schemas import LANDING_DDL
from tests.conftest import SF001, SF01

OK_TS = 1704067200
# (tx_id, amount, status, timestamp, expected reasons; empty = good)
FIXTURE = [
    ("ok", "10.5", " success ", OK_TS, []),
    ("half", "0,5", "success", OK_TS, []),
    ("big", "25000000", "success", OK_TS, []),
    ("zero", "0", "success", OK_TS, ["amount_not_positive"]),
    ("neg", "-5", "success", OK_TS, ["amount_not_positive"]),
    ("neghalf", "-0.5", "success", OK_TS, ["amount_not_positive"]),
    ("nan", "NaN", "success", OK_TS, ["amount_not_finite"]),
    ("inf", "Infinity", "success", OK_TS, ["amount_not_finite"]),
    ("comma", "1,234.56", "success", OK_TS, ["amount_unparsable"]),
    ("noamount", None, "success", OK_TS, ["amount_missing"]),
    ("nullts", "10", "success", None, ["timestamp_missing"]),
    ("epoch", "10", "success", 0, ["timestamp_not_after_epoch"]),
    ("pre", "10", "success", -5, ["timestamp_not_after_epoch"]),
    ("nullst", "10", None, OK_TS, ["status_missing"]),
    ("NA", "10", "N/A", OK_TS, ["status_unknown"]),
    ("empty", "10", "  ", OK_TS, ["status_unknown"]),
    ("lcnull", "10", " null", OK_TS, ["status_unknown"]),
    ("padNULL", "10", " NULL ", OK_TS, ["status_unknown"]),
    ("multi", "-1", "N/A", 0, ["amount_not_positive", "status_unknown", "timestamp_not_after_epoch"]),
]


@pytest.fixture()
def raw(spark):
    rows = [(t, " u 1 ", " r\t2 ", a, " USD ", s, ts) for t, a, s, ts, _ in FIXTURE]
    return spark.createDataFrame(rows, LANDING_DDL)


def test_routes_and_reasons(raw):
    tagged = cleaning.tag_transfers(cleaning.clean_transfers(raw))
    good = {r.tx_id for r in cleaning.good_rows(tagged).collect()}
    dlq = {r.tx_id: r.reject_reasons for r in cleaning.dlq_rows(tagged).collect()}
    for tx, _a, _s, _ts, reasons in FIXTURE:
        if reasons:
            assert tx in dlq and tx not in good, tx
            assert dlq[tx] == reasons, tx
        else:
            assert tx in good and tx not in dlq, tx


def test_normalisation(raw):
    row = cleaning.clean_transfers(raw).where("tx_id = 'half'").first()
    assert row.amount == 0.5 and row.sender_id == "u1" and row.receiver_id == "r2"
    assert row.currency == "USD" and row.status == "success"
    big = cleaning.good_transfers(raw).where("tx_id = 'big'").first()
    assert big.amount == 25_000_000.0


def test_dlq_stamp(raw):
    dlq = cleaning.dlq_transfers(raw)
    assert "dlq_processed_at" in dlq.columns
    assert dlq.where(F.col("dlq_processed_at").isNull()).count() == 0


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_good_and_dlq_partition_input(spark, sf):
    v = Views(spark, sf)
    n = v.raw.count()
    good, dlq = v.good, v.dlq
    assert good.count() + dlq.count() == n
    assert good.join(dlq, "tx_id").count() == 0


def test_flag_equals_no_reasons(spark):
    v = Views(spark, SF01)
    t = v.tagged.withColumn("r", cleaning.reject_reasons(v.tagged))
    assert t.where(F.col("is_good") != (F.size("r") == 0)).count() == 0


def test_reference_routes_find_lost_rows(spark):
    gap = cleaning.reference_routes(Views(spark, SF01).clean)
    routes = {(r.reference_route, r.our_route) for r in gap.select("reference_route", "our_route").distinct().collect()}
    assert ("lost", "good") in routes or ("lost", "dlq") in routes
    assert ("good", "dlq") in routes          # ' null' status passes the reference


def test_dedupe_keeps_first(spark):
    df = spark.createDataFrame([("b", 1, "x"), ("a", 1, "y"), ("c", 2, "z")], "tx_id string, k int, v string")
    out = {r.k: (r.tx_id, r.v) for r in cleaning.dedupe_transfers(df, ["k"], ["tx_id"]).collect()}
    assert out == {1: ("a", "y"), 2: ("c", "z")}


def test_fill_missing_timestamp(raw):
    filled = cleaning.fill_missing_timestamp(cleaning.clean_transfers(raw))
    assert filled.where("timestamp IS NULL").count() == 0


def test_optional_upper_bound(raw, spark):
    ms = spark.createDataFrame([("ms", "10", "success", OK_TS * 1000)], "tx_id string, amount string, status string, timestamp long")
    rows = raw.unionByName(ms.selectExpr("tx_id", "' u 1 ' AS sender_id", "' r2 ' AS receiver_id", "amount",
                                         "'USD' AS currency", "status", "timestamp"))
    good_default, _ = cleaning.split_transfers(rows)
    assert good_default.where("tx_id = 'ms'").count() == 1          # off by default
    good, dlq = cleaning.split_transfers(rows, max_epoch=4_102_444_800)   # 2100-01-01
    assert good.where("tx_id = 'ms'").count() == 0
    assert dlq.where("tx_id = 'ms'").select("reject_reasons").first()[0] == ["timestamp_after_bound"]
    assert good.count() + dlq.count() == rows.count()


def test_publish_on_bad(spark):
    from transferlake.operators.publish import event_fields
    df = spark.createDataFrame([("x", "1,234.56", 1, "r", "USD", "s")],
                               "status string, amount string, timestamp long, receiver_id string, currency string, sender_id string")
    assert event_fields(df).first().amount == 0.0
    assert event_fields(df, on_bad="null").first().amount is None


def test_reference_routes_on_fixture(raw):
    gap = {r.tx_id: (r.reference_route, r.our_route)
           for r in cleaning.reference_routes(cleaning.clean_transfers(raw)).collect()}
    assert gap["lcnull"] == ("good", "dlq")      # ' null' survives the original sentinel list
    assert gap["zero"] == ("lost", "dlq")        # amount 0 matches neither original filter
    assert gap["nullts"] == ("lost", "dlq")      # filled with the epoch, then neither filter
    assert gap["epoch"] == ("lost", "dlq")
    assert "neg" not in gap and "ok" not in gap  # same route in both
