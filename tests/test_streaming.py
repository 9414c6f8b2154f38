"""Stream behaviour: late rows, NULL event time, restart, idempotent batch writes."""

import json
import os
import time

from pyspark.sql import functions as F

from transferlake.operators.stats import flatten_window
from transferlake.session import local_path
from transferlake.sources.events import read_event_stream
from transferlake.streaming import sinks
from transferlake.streaming.stats_stream import run_available, sliding_stats_stream, stats_sink


def _write(path, name, events):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        for e in events:
            fh.write(json.dumps(e) + "\n")


def _ev(tx, ts, amount=10.0, status="success", receiver="R1", currency=None):
    return {"tx_id": tx, "status": status, "amount": amount, "timestamp": ts,
            "receiver_id": receiver, "currency": currency}


def _run(spark, src, base, dim):
    records = read_event_stream(spark, "files", path=src)
    agg = sliding_stats_stream(records, dim, observe_name="ingest")
    return run_available(agg, f"{base}/ckpt", stats_sink(f"{base}/stats"))


def test_late_null_restart(spark, tmp_dir):
    base = local_path(tmp_dir)
    src = os.path.join(base, "src")
    dim = spark.createDataFrame([("R1", "EUR")], "receiver_id string, currency string")
    t0 = 1704067200  # 2024-01-01 00:00:00
    _write(src, "a.json", [_ev(1, t0 + 30), _ev(2, t0 + 3600), _ev(3, None), _ev(4, t0 + 3600, receiver="R9")])
    q = _run(spark, src, base, dim)
    assert q.lastProgress is not None
    # a row 20 min behind the watermark (late) and one within the 15 min delay
    time.sleep(1.1)
    _write(src, "b.json", [_ev(5, t0 + 60), _ev(6, t0 + 3300)])
    _run(spark, src, base, dim)
    out = flatten_window(sinks.read_latest(spark, f"{base}/stats", ["window", "status", "currency"]))
    counts = {(r.window_start.timestamp(), r.currency): r.tx_count for r in out.collect()}
    start = lambda s: float(s)
    # tx 1 alone in the windows starting at 23:51..00:00; late tx 5 never counted
    assert counts[(start(t0), "EUR")] == 1
    # tx 2 (01:00, EUR) and tx 6 (00:55, within the delay) share the windows 00:51..00:55
    assert counts[(start(t0 + 3060), "EUR")] == 2
    # unmatched receiver keeps a NULL currency group
    assert counts[(start(t0 + 3600), None)] == 1
    # restart with nothing new: no double count
    _run(spark, src, base, dim)
    again = flatten_window(sinks.read_latest(spark, f"{base}/stats", ["window", "status", "currency"]))
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))


def test_null_event_time_is_observed(spark, tmp_dir):
    base = local_path(tmp_dir)
    src = os.path.join(base, "src")
    _write(src, "a.json", [_ev(1, None), _ev(2, 1704067200)])
    dim = spark.createDataFrame([("R1", "EUR")], "receiver_id string, currency string")
    q = _run(spark, src, base, dim)
    metrics = []
    for p in q.recentProgress:
        om = getattr(p, "observedMetrics", None) if not isinstance(p, dict) else p.get("observedMetrics")
        if om and om.get("ingest") is not None:
            metrics.append(om["ingest"])
    assert any(m and m["no_event_time"] == 1 and m["rows"] == 2 for m in metrics)


def test_batch_rewrite_is_idempotent(spark, tmp_dir):
    df = spark.createDataFrame([("k", 1)], "key string, v int")
    sinks.write_batch(df, f"{tmp_dir}/log", 3)
    sinks.write_batch(df, f"{tmp_dir}/log", 3)
    sinks.write_batch(df.withColumn("v", F.lit(2)), f"{tmp_dir}/log", 4)
    log = spark.read.parquet(f"{tmp_dir}/log")
    assert log.count() == 2
    assert [tuple(r) for r in sinks.latest_per_key(log, ["key"]).collect()] == [("k", 2)]


def test_malformed_and_overflow(spark):
    from transferlake.sources.events import decode_events
    df = spark.createDataFrame([('{"tx_id": 99999999999, "amount": 1.5}',), ('{"tx_id": 99999999999999999999, "amount": 2}',),
                                ("not json",), ("",)], "value string")
    rows = sorted(decode_events(df).collect(), key=lambda r: r.amount)
    # an id beyond INT is kept; one beyond BIGINT is NULL in that field only
    assert [(r.tx_id, r.amount) for r in rows] == [(99999999999, 1.5), (None, 2.0)]


def test_salted_join_equals_plain(spark):
    from transferlake.operators.enrich import enrich_events
    from transferlake.plans.views import Views
    from tests.conftest import SF001
    v = Views(spark, SF001)
    plain = enrich_events(v.events, v.dim)
    salted = enrich_events(v.events, v.dim, broadcast_dim=False, salt_buckets=5)
    assert salted.columns == plain.columns
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_append_mode_and_rocksdb(spark, tmp_dir):
    from transferlake.streaming.stats_stream import STATE_STORE_ROCKSDB
    base = local_path(tmp_dir)
    src = os.path.join(base, "src")
    t0 = 1704067200
    _write(src, "a.json", [_ev(1, t0 + 30), _ev(2, t0 + 7200)])
    dim = spark.createDataFrame([("R1", "EUR")], "receiver_id string, currency string")
    prev = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE_ROCKSDB)
    try:
        records = read_event_stream(spark, "files", path=src)
        agg = sliding_stats_stream(records, dim)
        run_available(agg, f"{base}/ckpt", lambda df, bid: sinks.write_batch(df, f"{base}/out", bid),
                      output_mode="append")
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", prev)
    out = spark.read.parquet(f"{base}/out")
    # append mode emits only windows closed by the watermark: tx 1's ten windows, not tx 2's
    assert out.count() == 10
    assert out.agg(F.sum("tx_count")).first()[0] == 10


def test_redelivered_events_counted_once(spark, tmp_dir):
    base = local_path(tmp_dir)
    src = os.path.join(base, "src")
    t0 = 1704067200
    _write(src, "a.json", [_ev(1, t0 + 30), _ev(2, t0 + 90)])
    _write(src, "b.json", [_ev(1, t0 + 30)])          # redelivered
    dim = spark.createDataFrame([("R1", "EUR")], "receiver_id string, currency string")
    records = read_event_stream(spark, "files", path=src)
    agg = sliding_stats_stream(records, dim, dedupe_key="tx_id")
    run_available(agg, f"{base}/ckpt", stats_sink(f"{base}/stats"))
    out = flatten_window(sinks.read_latest(spark, f"{base}/stats", ["window", "status", "currency"]))
    by_start = {r.window_start.timestamp(): r.tx_count for r in out.collect()}
    # the window starting 23:51 holds only tx 1 (twice delivered), the one at 00:00 tx 1 and 2
    assert by_start[float(t0 - 540)] == 1 and by_start[float(t0)] == 2


def test_events_without_id_are_not_duplicates_of_each_other(spark, tmp_dir):
    base = local_path(tmp_dir)
    src = os.path.join(base, "src")
    t0 = 1704067200
    _write(src, "a.json", [_ev(None, t0), _ev(None, t0 + 1), _ev(None, t0 + 1), _ev(9, t0), _ev(9, t0)])
    dim = spark.createDataFrame([("R1", "EUR")], "receiver_id string, currency string")
    agg = sliding_stats_stream(read_event_stream(spark, "files", path=src), dim, dedupe_key="tx_id")
    run_available(agg, f"{base}/ckpt", stats_sink(f"{base}/stats"))
    out = flatten_window(sinks.read_latest(spark, f"{base}/stats", ["window", "status", "currency"])).collect()
    one = next(r for r in out if r.window_start.timestamp() == t0)
    amount = one.total_sum / 3                          # two without an id, one with
    assert one.tx_count == 1 and abs(amount - round(amount, 6)) < 1e-6


def test_compacted_base_and_newer_batches(spark, tmp_dir):
    rows = lambda *r: spark.createDataFrame(r, "k string, v int")
    log, keys = f"{tmp_dir}/log", ["k"]
    sinks.write_batch(rows(("a", 1), ("b", 1)), log, 0)
    sinks.write_batch(rows(("a", 2)), log, 1)
    sinks.compact(spark, log, keys, f"{tmp_dir}/base1")
    sinks.write_batch(rows(("b", 3), ("c", 3)), log, 2)
    want = {("a", 2), ("b", 3), ("c", 3)}
    assert {tuple(r) for r in sinks.read_latest(spark, log, keys, f"{tmp_dir}/base1").collect()} == want
    folded = sinks.compact(spark, log, keys, f"{tmp_dir}/base2", f"{tmp_dir}/base1")
    assert {tuple(r) for r in folded.select("k", "v").collect()} == want
    assert {tuple(r) for r in sinks.read_latest(spark, log, keys, f"{tmp_dir}/base2").collect()} == want


def test_dual_sink_external_serving_branch(spark, tmp_dir):
    """The serving side through a format writer with caller options (as JDBC would be)."""
    base = local_path(tmp_dir)
    src = os.path.join(base, "src")
    _write(src, "a.json", [_ev(1, 1704067200), _ev(2, 1704067260)])
    dim = spark.createDataFrame([("R1", "EUR")], "receiver_id string, currency string")
    sink = sinks.DualSink(f"{base}/lake", serving_format="json",
                          serving_options={"path": f"{base}/serving"}, flatten=flatten_window)
    agg = sliding_stats_stream(read_event_stream(spark, "files", path=src), dim)
    run_available(agg, f"{base}/ckpt", sink)
    served = spark.read.json(f"{base}/serving")
    assert served.count() == spark.read.parquet(f"{base}/lake").count() > 0
    assert {"window_start", "window_end", "status", "currency", "total_sum", "tx_count"} <= set(served.columns)


def test_rate_limit_one_file_per_batch(spark, tmp_dir):
    base = local_path(tmp_dir)
    src = os.path.join(base, "src")
    t0 = 1704067200
    for i in range(3):
        _write(src, f"{i}.json", [_ev(i, t0 + 60 * i)])
        time.sleep(0.05)
    dim = spark.createDataFrame([("R1", "EUR")], "receiver_id string, currency string")
    records = read_event_stream(spark, "files", path=src, max_per_trigger=1)
    q = run_available(sliding_stats_stream(records, dim), f"{base}/ckpt", stats_sink(f"{base}/stats"))
    data_batches = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(data_batches) == 3 and all(p["numInputRows"] == 1 for p in data_batches)


def test_alerts_parse_amount_leniently(spark, tmp_dir):
    from transferlake.streaming.stats_stream import stream_alerts
    base = local_path(tmp_dir)
    src = os.path.join(base, "src")
    os.makedirs(src, exist_ok=True)
    with open(os.path.join(src, "a.json"), "w") as fh:
        fh.write('{"tx_id": 1, "amount": 60000.5, "receiver_id": "R1"}\n')
        fh.write('{"tx_id": 2, "amount": "70000,25", "receiver_id": "R2"}\n')
        fh.write('{"tx_id": 3, "amount": "abc", "receiver_id": "R3"}\n')
        fh.write('{"tx_id": 4, "receiver_id": "R4"}\n')
        fh.write('not json\n')
        fh.write('{"tx_id": 5, "amount": 10, "receiver_id": "R5"}\n')
    alerts = stream_alerts(read_event_stream(spark, "files", path=src), 50000.0)
    run_available(alerts, f"{base}/ckpt", lambda df, bid: sinks.write_batch(df, f"{base}/out", bid),
                  output_mode="append")
    got = {r.tx_id: r.amount for r in spark.read.parquet(f"{base}/out").collect()}
    assert got == {1: 60000.5, 2: 70000.25}


def test_kafka_option_mapping():
    from transferlake.sources.events import kafka_options
    opts = kafka_options({"kafka.bootstrap.servers": "broker:9092", "subscribe": "transfers"}, 4000)
    assert opts == {"startingOffsets": "earliest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "4000",
                    "kafka.bootstrap.servers": "broker:9092", "subscribe": "transfers"}
    assert kafka_options({"startingOffsets": "latest"})["startingOffsets"] == "latest"


def test_merge_rewrites_only_the_days_it_touches(spark, tmp_dir):
    import glob
    from transferlake.session import local_path
    log, base, keys = f"{tmp_dir}/log", f"{tmp_dir}/base", ["window", "status"]

    def batch(n, rows):
        df = spark.createDataFrame(rows, "day int, hour int, status string, total double")
        start = F.timestamp_seconds(F.col("day") * 86400 + F.col("hour") * 3600)
        sinks.write_batch(df.select(F.struct(start.alias("start"), (start + F.expr("INTERVAL 10 MINUTE")).alias("end")).alias("window"), "status", "total"), log, n)

    def files(day):
        return {os.path.basename(f) for f in glob.glob(f"{local_path(base)}/rows/_day={day}/*.parquet")}

    def state():
        rows = sinks.read_merged(spark, log, keys, base).selectExpr("CAST(unix_timestamp(window.start) AS BIGINT) AS at", "status", "total").collect()
        return {(r["at"] // 86400, r["at"] % 86400 // 3600, r["status"]): r["total"] for r in rows}
    batch(0, [(1, 0, "a", 1.0), (1, 5, "a", 2.0), (2, 0, "a", 3.0), (3, 23, None, 4.0)])
    batch(1, [(1, 0, "a", 10.0)])
    assert sinks.merge_batches(spark, log, keys, base, "window.start") == 3
    old = {d: files(d) for d in (1, 2, 3)}
    assert all(old.values())
    batch(2, [(2, 0, "a", 30.0), (2, 1, "b", 5.0)])
    expected = {(1, 0, "a"): 10.0, (1, 5, "a"): 2.0, (2, 0, "a"): 30.0, (2, 1, "b"): 5.0, (3, 23, None): 4.0}
    assert state() == expected                                     # read over the base before the merge
    assert sinks.merge_batches(spark, log, keys, base, "window.start") == 1
    assert files(1) == old[1] and files(3) == old[3] and not files(2) & old[2]
    assert state() == expected
    assert sinks.merge_batches(spark, log, keys, base, "window.start") == 0 and files(2)


def test_a_failed_merge_is_made_again(spark, tmp_dir, monkeypatch):
    log, base = f"{tmp_dir}/log", f"{tmp_dir}/base"
    start = F.timestamp_seconds(F.col("id") * 86400)
    for n in (0, 1):
        sinks.write_batch(spark.range(5).select(F.struct(start.alias("start")).alias("window"), (F.col("id") + 100 * n).alias("v")), log, n)
        if n:
            monkeypatch.setattr(sinks, "_mark_merged", lambda *_: 1 / 0)
            try:
                sinks.merge_batches(spark, log, ["window"], base, "window.start")
            except ZeroDivisionError:
                pass
            monkeypatch.undo()
        assert sinks.merge_batches(spark, log, ["window"], base, "window.start") == 5
        got = sorted(r["v"] for r in sinks.read_merged(spark, log, ["window"], base).collect())
        assert got == [i + 100 * n for i in range(5)]


def test_only_hot_receivers_are_salted(spark):
    from transferlake.operators.enrich import enrich_events, hot_receivers
    from transferlake.plans.views import Views
    from transferlake.sources.testdata import with_hot_receiver
    from tests.conftest import SF001
    v = Views(spark, SF001)
    events = with_hot_receiver(v.events)
    hot = hot_receivers(events, 0.1)
    assert "R7" in hot and len(hot) <= 10
    plain = enrich_events(events, v.dim, broadcast_dim=False)
    for names in (hot, [], None):
        salted = enrich_events(events, v.dim, broadcast_dim=False, salt_buckets=5, hot=names)
        assert salted.columns == plain.columns and salted.exceptAll(plain).count() == 0 and salted.count() == plain.count()
    # the dimension grows by the salted receivers' rows only
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salted = enrich_events(events, v.dim, salt_buckets=5, hot=hot)
        salted.collect()
        plan = salted._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
    assert "Generate explode" in plan and "SortMergeJoin" in plan
    assert hot_receivers(events.where("receiver_id IS NULL")) == []


def test_audit_accounts_for_every_event(spark, tmp_dir):
    from transferlake.sources.events import decode_events
    from transferlake.streaming.stats_stream import AUDIT_DDL, audit_batch, progress_rows
    src, base = f"{tmp_dir}/src", f"{tmp_dir}/audit"
    t = 1_700_000_000 // 60 * 60
    chunks = [[_ev("1", t), _ev("2", None), _ev("3", t + 3600)],            # watermark from here on: t + 3600 - 900
              [_ev("4", t + 3600 - 900 - 600), _ev("5", t + 3600 - 900 - 600 - 1), _ev("6", t), _ev("7", t + 3600 - 900 - 540)], [_ev("8", None)]]
    seen = []
    for i, events in enumerate(chunks):
        _write(src, f"f{i}", events)
        q = run_available(decode_events(read_event_stream(spark, "files", path=src)), f"{tmp_dir}/ck", audit_batch(base), output_mode="append")
        seen += progress_rows(q)
    rows = spark.read.schema(AUDIT_DDL).parquet(base).orderBy("batch_id").collect()
    assert [(r["events"], r["no_event_time"], r["late"]) for r in rows] == [(3, 1, 0), (4, 0, 3), (1, 1, 0)]
    assert sum(r["input_rows"] for r in seen) == 8
    audit_batch(base)(spark.createDataFrame([], "timestamp bigint"), 7)       # an empty batch
    assert spark.read.schema(AUDIT_DDL).parquet(base).where("batch_id = 7").first()["events"] == 0
