"""Landing CSV (positional / by header, provenance), publishing order and cap, DLQ append, DDL."""

import os

import pytest
from pyspark.sql import functions as F

from transferlake.operators import cleaning
from transferlake.operators.publish import publish_events
from transferlake.plans.views import Views
from transferlake.session import local_path
from transferlake.sources import landing
from transferlake.sources import tables as tb
from tests.conftest import SF001


def test_csv_positional_and_by_header(spark, tmp_dir):
    raw = Views(spark, SF001).raw
    path = f"{tmp_dir}/landing"
    landing.write_landing(raw.repartition(3), path)
    by_pos = landing.read_landing(spark, path, with_source=True)
    assert by_pos.count() == raw.count()
    per_file = landing.files_by_source(by_pos)
    assert per_file.count() == 3
    assert per_file.agg(F.sum("n_rows")).first()[0] == raw.count()
    # header order differs from the declared order: bound by name it still lines up
    swapped = f"{tmp_dir}/swapped"
    landing.write_landing(raw.select("status", "tx_id", "sender_id", "receiver_id", "amount", "currency", "timestamp"), swapped)
    by_name = landing.read_landing(spark, swapped, by_header=True)
    assert by_name.select(*raw.columns).exceptAll(raw).count() == 0
    with pytest.raises(Exception):
        landing.read_landing(spark, swapped, validate_header=True).collect()
    # files with different column orders in one folder: each binds by its own header
    mixed = f"{tmp_dir}/mixed"
    landing.write_landing(raw.where("tx_id < '5'").select("status", "tx_id", "sender_id", "receiver_id", "amount", "currency", "timestamp"), mixed)
    landing.write_landing(raw.where("tx_id >= '5'").select("timestamp", "currency", "amount", "receiver_id", "sender_id", "tx_id", "status"), mixed, mode="append")
    assert len(spark.read.csv(mixed).inputFiles()) >= 2
    both = landing.read_landing(spark, mixed, by_header=True)
    assert both.select(*raw.columns).exceptAll(raw).count() == 0 and both.count() == raw.count()
    # a wider file whose columns come in another place: nothing is lost, the rest is ignored
    wide = f"{tmp_dir}/wide"
    landing.write_landing(raw.select(F.lit("b7").alias("batch"), *reversed(raw.columns), F.lit("x,y").alias("note")), wide)
    landing.write_landing(raw, wide, mode="append")
    out = landing.read_landing(spark, wide, by_header=True)
    assert out.count() == 2 * raw.count() and out.exceptAll(raw.unionByName(raw)).count() == 0
    # blanks survive the round trip (the writer trims them unless told not to)
    assert by_pos.where("status = '  '").count() == raw.where("status = '  '").count() > 0


def test_publish_order_follows_files_and_cap(spark, tmp_dir):
    raw = Views(spark, SF001).raw
    path = f"{tmp_dir}/landing"
    landing.write_landing(raw.repartition(4), path)
    df = landing.read_landing(spark, path, by_header=True, with_source=True)
    order = [F.col("source_file"), F.col("source_block"), F.col("source_row")]
    pub = publish_events(df, order, num_partitions=3)
    rows = pub.orderBy("tx_id").collect()
    assert [r.tx_id for r in rows] == list(range(1, raw.count() + 1))
    capped = publish_events(df, order, cap=100, num_partitions=3)
    assert capped.count() == 100 and capped.agg(F.max("tx_id")).first()[0] == 100
    # a cap keeps the first rows of the full numbering
    assert sorted(map(tuple, capped.collect())) == [(r.tx_id, r.value) for r in rows[:100]]
    assert raw.where("timestamp IS NULL").count() > 0
    nulls = [r.value for r in rows if '"timestamp":null' in r.value]
    assert len(nulls) == raw.where("timestamp IS NULL").count()


def test_dlq_parquet_append(spark, tmp_dir):
    raw = Views(spark, SF001).raw
    dlq = cleaning.dlq_transfers(raw)
    n = dlq.count()
    tb.write_parquet(tb.layout_few_files(dlq), f"{tmp_dir}/dlq", mode="append")
    tb.write_parquet(tb.layout_few_files(dlq), f"{tmp_dir}/dlq", mode="append")
    assert spark.read.parquet(f"{tmp_dir}/dlq").count() == 2 * n
    lp = local_path(f"{tmp_dir}/dlq")
    if lp:
        assert len([f for f in os.listdir(lp) if f.endswith(".parquet")]) <= 6


def test_ddl_and_views(spark, tmp_dir):
    tb.create_tables(spark, "tl_test", f"{tmp_dir}/warehouse")
    tb.create_tables(spark, "tl_test", f"{tmp_dir}/warehouse")
    assert {t.name for t in spark.catalog.listTables("tl_test")} >= {"transfers", "dead_letters", "windowed_stats"}
    cols = {c.name: c.dataType for c in spark.catalog.listColumns("windowed_stats", "tl_test")}
    assert cols["window"].startswith("struct")
    good = Views(spark, SF001).good
    tb.write_load(good, f"{tmp_dir}/t", 1, "replace")
    tb.read_table(spark, f"{tmp_dir}/t").createOrReplaceTempView("lake_transfers")
    v = tb.create_projection_view(spark, "lake_transfers_view", "lake_transfers", temporary=True)
    assert v.columns == ["tx_id", "amount", "currency", "status", "timestamp"]
    counts = spark.sql("SELECT status, COUNT(*) AS count FROM lake_transfers GROUP BY status").collect()
    assert sum(r["count"] for r in counts) == good.count()
    tb.drop_table(spark, "tl_test.windowed_stats")
    assert "windowed_stats" not in {t.name for t in spark.catalog.listTables("tl_test")}


def test_landing_job_scans_once_and_splits_exactly(spark, tmp_dir):
    from transferlake.plans.jobs import load_landing
    raw = Views(spark, SF001).raw
    landing.write_landing(raw, f"{tmp_dir}/landing")
    out = load_landing(spark, f"{tmp_dir}/landing", f"{tmp_dir}/t", f"{tmp_dir}/dlq", 1, "replace")
    good = tb.read_table(spark, f"{tmp_dir}/t")
    dlq = spark.read.parquet(f"{tmp_dir}/dlq")
    assert out["good_rows"] == good.count()
    assert good.count() + dlq.count() == raw.count()
    # rerunning the same load replaces its own outputs
    load_landing(spark, f"{tmp_dir}/landing", f"{tmp_dir}/t", f"{tmp_dir}/dlq", 1, "replace")
    assert tb.read_table(spark, f"{tmp_dir}/t").count() + spark.read.parquet(f"{tmp_dir}/dlq").count() == raw.count()


def test_published_events_round_trip(spark, tmp_dir):
    from transferlake.schemas import EVENT_DDL
    from transferlake.sources.events import decode_events, write_events
    raw = Views(spark, SF001).raw
    pub = publish_events(raw, [F.col("tx_id").cast("bigint")])
    write_events(pub, "text", path=f"{tmp_dir}/topic")
    back = decode_events(spark.read.text(f"{tmp_dir}/topic"), EVENT_DDL)
    assert back.count() == raw.count()
    assert back.where("currency IS NULL").count() == 0      # all columns are published


def test_headers_cost_no_scan(spark, tmp_dir):
    raw = Views(spark, SF001).raw
    landing.write_landing(raw.repartition(3), f"{tmp_dir}/in")
    landing.write_landing(raw.select(*reversed(raw.columns)), f"{tmp_dir}/in", mode="append")
    found = landing.headers(spark, spark.read.text(f"{tmp_dir}/in").inputFiles())
    assert {k: len(v) for k, v in found.items()} == {tuple(raw.columns): 3, tuple(reversed(raw.columns)): 1}
    df = landing.read_landing(spark, f"{tmp_dir}/in", by_header=True)
    plan = df.select("status")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2 and "Join" not in plan and "Exchange" not in plan      # a scan for each header
    assert df.count() == 2 * raw.count()


def test_odd_headers(spark, tmp_dir):
    folder = local_path(f"{tmp_dir}/odd dir")
    os.makedirs(folder)
    texts = {"a b.csv": '﻿status,"amount",status,x\r\nok,1.5,no,3\r\n', "empty.csv": "", "head.csv": "tx_id,timestamp\n",
             "no names.csv": "p,q\n1,2\n", "short.csv": "tx_id,status,timestamp\nt1\nt2,ok,12\nt3,bad,notanumber\n", "last line.csv": "tx_id\nt9"}
    for name, text in texts.items():
        with open(f"{folder}/{name}", "w", encoding="utf-8", newline="") as f:
            f.write(text)
    rows = landing.read_landing(spark, f"{tmp_dir}/odd dir", by_header=True, with_source=True)
    got = sorted((r["tx_id"], r["status"], r["amount"], r["timestamp"]) for r in rows.fillna("-", ["tx_id", "status", "amount"]).fillna(-1, ["timestamp"]).collect())
    assert got == [("-", "-", "-", -1), ("-", "ok", "1.5", -1), ("t1", "-", "-", -1), ("t2", "ok", "-", 12), ("t3", "bad", "-", -1), ("t9", "-", "-", -1)]
    assert landing.read_landing(spark, [f"{tmp_dir}/odd dir/empty.csv"], by_header=True, with_source=True).count() == 0


def test_publish_in_file_order_reads_what_a_cap_needs(spark, tmp_dir):
    from transferlake.operators.publish import capped_files
    raw = Views(spark, SF001).raw
    for i in range(8):
        landing.write_landing(raw.where(f"CAST(tx_id AS BIGINT) % 8 = {i}").coalesce(1), f"{tmp_dir}/in/part{i}")
    every = f"{tmp_dir}/in/*"

    def read(paths):
        return landing.read_landing(spark, paths, by_header=True, with_source=True)
    whole = publish_events(read(every)).orderBy("tx_id").collect()
    assert [r.tx_id for r in whole] == list(range(1, raw.count() + 1))
    order = [F.col("source_file"), F.col("source_block"), F.col("source_row")]
    assert whole == publish_events(read(every), order).orderBy("tx_id").collect()
    files = sorted((r["source_file"], r["length"]) for r in landing.landing_files(spark, every).collect())
    used = capped_files(read, files, 300, first_bytes=1)
    assert len(used) in (2, 3) and used == [f for f, _ in files[:len(used)]]       # a file, then about two more: the others are never opened
    capped = publish_events(read(used), cap=300)
    assert len([f for f in capped.inputFiles() if f.endswith(".csv")]) == len(used)
    assert sorted(capped.collect()) == whole[:300]
    from transferlake.plans.jobs import publish_landing
    assert publish_landing(spark, every, out_path=f"{tmp_dir}/out", cap=300) == 300
    assert publish_landing(spark, every, out_path=f"{tmp_dir}/all", cap=10 ** 9) == len(whole)
    assert sorted(r.value for r in spark.read.text(f"{tmp_dir}/out").collect()) == sorted(r.value for r in whole[:300])


def test_loaded_files_are_not_read_again(spark, tmp_dir, monkeypatch):
    from transferlake.plans.jobs import load_landing
    raw = Views(spark, SF001).raw
    inbox = f"{tmp_dir}/in"
    landing.write_landing(raw.repartition(3), inbox)

    def load(n):
        return load_landing(spark, inbox, f"{tmp_dir}/t", f"{tmp_dir}/dlq", n, only_new=True)

    def rows():
        return tb.read_table(spark, f"{tmp_dir}/t").count() + spark.read.parquet(f"{tmp_dir}/dlq").count()
    assert load(1)["files"] == 3 and rows() == raw.count()
    assert load(2) == {"load_id": 2, "files": 0, "good_rows": 0} and rows() == raw.count()
    assert load(1)["files"] == 3 and rows() == raw.count()                 # a load run again reads its files again
    landing.write_landing(raw.limit(100).coalesce(1), inbox, mode="append")
    # a load that fails before its record has read nothing
    monkeypatch.setattr(tb, "_record_loads", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        load(3)
    monkeypatch.undo()
    assert load(4)["files"] == 1
    loads = {r["load_id"] for r in tb.read_table(spark, f"{tmp_dir}/t", with_load=True).select("load_id").distinct().collect()}
    assert loads == {1, 4}
