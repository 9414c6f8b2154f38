"""Lake table loads, history, as-of, rollback, file listing, compaction, layouts."""

import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from transferlake.plans.views import Views
from transferlake.session import local_path
from transferlake.sources import tables as tb
from tests.conftest import SF001, SF01


def _year():
    return F.year(F.col("timestamp"))


def test_loads_as_of_rollback(spark, tmp_dir):
    good = Views(spark, SF01).good
    tb.write_load(good.where(_year() < 1997), tmp_dir, 1, "replace")
    tb.write_load(good.where(_year() == 1997), tmp_dir, 2, "append")
    tb.write_load(good.where(_year() >= 1998), tmp_dir, 3, "replace")
    n_1997 = good.where(_year() <= 1997).count()
    assert tb.read_table(spark, tmp_dir).count() == good.where(_year() >= 1998).count()
    assert tb.read_table(spark, tmp_dir, as_of=2).count() == n_1997
    assert tb.read_table(spark, tmp_dir, as_of=0).count() == 0
    assert [r.load_id for r in tb.visible_loads(spark, tmp_dir, as_of=10).collect()] == [3]
    rid = tb.rollback(spark, tmp_dir, 2)
    assert tb.read_table(spark, tmp_dir).count() == n_1997
    hist = tb.load_history(spark, tmp_dir, 5).collect()
    assert [h.load_id for h in hist] == [rid, 3, 2, 1]
    assert hist[0].operation == "rollback" and hist[0].target == 2
    assert [h.n_rows for h in hist[1:]] == [good.where(_year() >= 1998).count(),
                                           good.where(_year() == 1997).count(),
                                           good.where(_year() < 1997).count()]
    # appends after a rollback build on the rolled-back state
    tb.write_load(good.where(_year() >= 1998), tmp_dir, rid + 1, "append")
    assert tb.read_table(spark, tmp_dir).count() == good.count()


def test_a_table_of_thousands_of_loads_still_plans(spark, tmp_dir):
    good = Views(spark, SF01).good
    tb.write_load(good, tmp_dir, 1, "replace")
    import datetime as dt
    tb._record_loads(spark, tmp_dir, [(i, "append", dt.datetime(2030, 1, 1), 0, None) for i in range(2, 5002)])
    tb.write_load(good, tmp_dir, 6000, "append")
    assert tb.read_table(spark, tmp_dir).count() == 2 * good.count()
    assert tb.visible_loads(spark, tmp_dir).count() == 5002
    plan = tb.read_table(spark, tmp_dir)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


def test_empty_loads(spark, tmp_dir):
    good = Views(spark, SF01).good
    assert tb.write_load(good.limit(0), tmp_dir, 1, "replace") == 0
    assert tb.read_table(spark, tmp_dir).count() == 0
    tb.write_load(good, tmp_dir, 2, "append")
    assert tb.write_load(good.limit(0), tmp_dir, 3, "replace") == 0
    assert tb.read_table(spark, tmp_dir).count() == 0 and tb.read_table(spark, tmp_dir, 2).count() == good.count()


def test_rerun_load_is_idempotent(spark, tmp_dir):
    good = Views(spark, SF01).good
    tb.write_load(good, tmp_dir, 1, "replace")
    tb.write_load(good, tmp_dir, 1, "replace")
    assert tb.read_table(spark, tmp_dir).count() == good.count()
    assert tb.load_history(spark, tmp_dir, None).count() == 1
    # a rerun with different content replaces the whole load, statuses it lacks included
    tb.write_load(good.where("status = 'failed'"), tmp_dir, 1, "replace")
    state = tb.read_table(spark, tmp_dir)
    assert state.count() == good.where("status = 'failed'").count()
    assert {r.status for r in state.select("status").distinct().collect()} == {"failed"}
    assert tb.partition_summary(spark, tmp_dir).count() == 1


def test_files_sum_to_table_and_compaction(spark, tmp_dir):
    good = Views(spark, SF01).good
    # many small files, as a stream of small appends leaves behind
    import datetime as dt
    for i in range(3):
        (good.withColumn("load_id", F.lit(i + 1).cast("bigint"))
             .repartition(12).write.mode("append").partitionBy("load_id", "status").parquet(f"{tmp_dir}/data"))
        tb._record_loads(spark, tmp_dir, [(i + 1, "append" if i else "replace", dt.datetime.now(), None, None)])
    files = tb.table_files(spark, tmp_dir)
    total = tb.read_table(spark, tmp_dir).count()
    assert files.agg(F.sum("record_count")).first()[0] == total
    assert total == 3 * good.count()
    before = files.count()
    tb.compact_files(spark, tmp_dir, [1, 2, 3])
    after = tb.table_files(spark, tmp_dir)
    assert after.count() < before
    assert tb.read_table(spark, tmp_dir).count() == total


def test_partition_filter_reaches_scan(spark, tmp_dir):
    good = Views(spark, SF01).good
    tb.write_load(good, tmp_dir, 1, "replace")
    q = tb.read_table(spark, tmp_dir).where("status = 'pending' AND amount > 10000 AND currency = 'USD'")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "status" in plan
    assert "PushedFilters" in plan and "GreaterThan(amount" in plan
    assert q.count() == good.where("status = 'pending' AND amount > 10000 AND currency = 'USD'").count()


def test_layouts(spark, tmp_dir):
    good = Views(spark, SF01).good
    p = f"{tmp_dir}/sorted"
    tb.layout_sorted(good, 2).write.parquet(p)
    lp = local_path(p)
    if lp:
        assert len(glob.glob(os.path.join(lp, "*.parquet"))) == 2
    for f in spark.read.parquet(p).select(F.input_file_name().alias("f")).distinct().collect():
        st = [r.status for r in spark.read.parquet(f.f).select("status").collect()]
        assert st == sorted(st)
    p2 = f"{tmp_dir}/bystatus"
    tb.layout_by_status(good).write.partitionBy("status").parquet(p2)
    assert spark.read.parquet(p2).count() == good.count()


def test_serving_layout_files_are_sorted_and_disjoint(spark, tmp_dir):
    from transferlake.operators import stats
    v = Views(spark, SF01)
    flat = stats.sliding_stats(v.enriched, money_scale=2)
    tb.write_serving(stats.serving_layout(flat, num_partitions=4), "parquet", path=f"{tmp_dir}/serving")
    out = spark.read.parquet(f"{tmp_dir}/serving").withColumn("f", F.input_file_name())
    ranges = []
    for f in [r.f for r in out.select("f").distinct().collect()]:
        rows = [(r.window_start, r.status) for r in spark.read.parquet(f).select("window_start", "status").collect()]
        assert rows == sorted(rows)
        ranges.append((rows[0], rows[-1]))
    ranges.sort()
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    assert out.count() == flat.count()


def files_of(spark, path):
    return {r["file"] for r in tb.data_files(spark, path).collect()}


def two_loads(spark, path):
    """Load 1: many small files of each status; load 2: one file of each status."""
    good = Views(spark, SF001).good
    tb.write_load(good, path, 1, "replace")
    small = good.repartition(6)
    small.write.mode("overwrite").partitionBy("status").parquet(f"{path}/data/load_id=1")
    tb.write_load(good.where("amount > 1000"), path, 2, "append")
    return tb.read_table(spark, path, with_load=True)


def test_compaction_rewrites_only_partitions_it_can_shrink(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    before = sorted(map(repr, two_loads(spark, path).collect()))
    old = files_of(spark, path)
    n = tb.compact_files(spark, path)
    new = files_of(spark, path)
    statuses = Views(spark, SF001).good.select("status").distinct().count()
    assert n == statuses
    assert {f for f in old if "load_id=2" in f} <= new                        # one file a partition: left alone
    assert len([f for f in new if "load_id=1" in f]) == statuses
    assert sorted(map(repr, tb.read_table(spark, path, with_load=True).collect())) == before
    assert tb.compact_files(spark, path) == 0 and files_of(spark, path) == new
    assert tb.compact_files(spark, path, [2]) == 0


def test_compaction_packs_files_into_bins(spark):
    sizes = [40, 50, 30, 60, 500, 10, 10]
    files = spark.createDataFrame([(1, "a", f"f{i}", n) for i, n in enumerate(sizes)] + [(2, "a", "f0", 500), (3, None, "f0", 10), (3, None, "f1", 10)],
                                  "load_id bigint, status string, file string, length bigint")
    bins = {}
    for r in tb.small_file_bins(files, 100).collect():
        bins.setdefault((r["load_id"], r["status"], r["bin"]), set()).add(r["file"])
    assert bins == {(1, "a", 0): {"f0", "f1", "f2"}, (1, "a", 1): {"f3", "f4"}, (1, "a", 6): {"f5", "f6"}, (3, None, 0): {"f0", "f1"}}


def test_a_failed_compaction_loses_nothing(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    before = sorted(map(repr, two_loads(spark, path).collect()))
    put = tb._put_in_place

    def fails(*_):
        raise OSError("lost")
    monkeypatch.setattr(tb, "_put_in_place", fails)
    with pytest.raises(OSError):
        tb.compact_files(spark, path)
    assert sorted(map(repr, tb.read_table(spark, path, with_load=True).collect())) == before

    def half(spark, path, staged):
        put(spark, path, staged)
        # a partition is gone when the commit breaks off
        shutil.rmtree(f"{local_path(path)}/data/load_id=1/status=pending", ignore_errors=True)
        raise OSError("lost")
    monkeypatch.setattr(tb, "_put_in_place", half)
    with pytest.raises(OSError):
        tb.compact_files(spark, path)
    monkeypatch.setattr(tb, "_put_in_place", put)
    tb.compact_files(spark, path)
    assert sorted(map(repr, tb.read_table(spark, path, with_load=True).collect())) == before


def test_rollback_writes_no_data(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    good = Views(spark, SF001).good
    tb.write_load(good.where("amount < 1000"), path, 1, "replace")
    tb.write_load(good.where("amount >= 1000 AND amount < 100000"), path, 2, "append")
    tb.write_load(good.where("amount >= 100000"), path, 3, "replace")
    old = files_of(spark, path)

    def state(as_of=None):
        return {r["load_id"] for r in tb.visible_loads(spark, path, as_of).collect()}
    assert tb.rollback(spark, path, 2) == 4 and state() == {1, 2} and files_of(spark, path) == old
    n = tb.read_table(spark, path).count()
    assert tb.load_history(spark, path, 1).first()["n_rows"] == n == good.where("amount < 100000").count()
    tb.write_load(good.where("amount >= 100000"), path, 5, "append")
    assert state() == {1, 2, 5} and state(4) == {1, 2} and state(3) == {3}
    assert tb.rollback(spark, path, 3) == 6 and state() == {3}                  # over the rollback, to the reload
    assert tb.rollback(spark, path, 5) == 7 and state() == {1, 2, 5}            # back to a load on a rollback
    assert tb.rollback(spark, path, 7) == 8 and state() == {1, 2, 5}            # a rollback of a rollback
    assert tb.rollback(spark, path, 1) == 9 and state() == {1} and state(7) == {1, 2, 5}


def test_files_of_a_target_size(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    good = Views(spark, "/root/testdata/sf0.1").good
    tb.write_load(good, path, 1, "replace", target_bytes=200_000)               # nothing to learn from yet
    assert tb.write_load(good, path, 2, "append", target_bytes=200_000) == good.count()
    sizes = tb.data_files(spark, path).where("load_id = 2").groupBy("status").agg({"length": "collect_list"}).collect()
    for _, own in sizes:
        # a status of less than the target has one file
        assert all(100_000 <= n <= 400_000 for n in own) or len(own) == 1 and own[0] <= 400_000
    assert sum(len(own) for _, own in sizes) > 4
