"""Distributed running number and skew-safe LAG against plain window results."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from transferlake.operators.ordering import lag_in_group, number_in_place, running_number, split_offsets


def skewed(spark, n=3000):
    # sender 'hot' holds a third of all rows; duplicate timestamps force the tx tie-break
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), (F.col("id") % 97).cast("string"))).alias("sender_id"),
        F.format_string("%06d", "id").alias("tx_id"),
        (F.col("id") % 50).alias("ts"),
        (F.col("id") * 1.5).alias("amount"))


def test_running_number_dense_and_ordered(spark):
    df = skewed(spark)
    out = running_number(df, ["ts", "tx_id"], "seq", num_partitions=7)
    ref = df.withColumn("seq", F.row_number().over(Window.orderBy("ts", "tx_id")).cast("bigint"))
    assert out.count() == df.count()
    assert out.select("tx_id", "seq").subtract(ref.select("tx_id", "seq")).count() == 0


def scan(spark, path):
    return spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"),
                                           F.monotonically_increasing_id().alias("r"))


def test_rows_of_a_scan_are_numbered_in_place(spark, tmp_dir):
    skewed(spark).repartition(5, "tx_id").write.parquet(f"{tmp_dir}/t")
    df = scan(spark, f"{tmp_dir}/t")
    out = number_in_place(df, ["f", "b"], "r", "seq")
    rows = sorted(out.select("seq", "tx_id").collect())
    assert [r.seq for r in rows] == list(range(1, 3001))
    assert out.columns == ["seq", "sender_id", "tx_id", "ts", "amount"]
    # the order is that of the files and of the rows in them
    ordered = df.orderBy("f", "b", "r").collect()
    assert [r.tx_id for r in rows] == [r.tx_id for r in ordered]
    capped = sorted(number_in_place(df, ["f", "b"], "r", "seq", cap=700).select("seq", "tx_id").collect())
    assert capped == rows[:700]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan      # only the splits are exchanged
    assert number_in_place(df.limit(0), ["f", "b"], "r", "seq").count() == 0


def test_numbering_fails_if_the_scan_was_cut_otherwise(spark, tmp_dir):
    skewed(spark).repartition(3, "tx_id").write.parquet(f"{tmp_dir}/t")
    df = scan(spark, f"{tmp_dir}/t")
    offsets = split_offsets(df, ["f", "b"], "r")
    with pytest.raises(Exception, match="split anew"):
        number_in_place(df.withColumn("r", F.col("r") + 1), ["f", "b"], "r", "seq", offsets).collect()
    with pytest.raises(Exception, match="split anew"):
        number_in_place(df.withColumn("b", F.col("b") + 4), ["f", "b"], "r", "seq", offsets).collect()


def test_lag_matches_window_and_splits_hot_group(spark):
    df = skewed(spark)
    # a third of the rows has no sender; a value is missing now and then
    df = df.withColumn("sender_id", F.when(F.col("sender_id") != "hot", F.col("sender_id"))) \
           .withColumn("amount", F.when(F.col("amount") % 7 != 0, F.col("amount")))
    w = Window.partitionBy("sender_id").orderBy("ts", "tx_id")
    ref = df.withColumn("prev", F.lag("amount").over(w))
    for hot_rows in (1, 15, 400, 10_000):      # every group cut; some; the one without sender; none
        out = lag_in_group(df, "sender_id", ["ts", "tx_id"], "amount", "prev", hot_rows)
        diff = out.select("tx_id", "prev").exceptAll(ref.select("tx_id", "prev"))
        assert diff.count() == 0 and out.count() == df.count()


def test_lag_of_few_rows_null_values_and_times(spark):
    df = spark.createDataFrame([(None, "a", None, 1.0), (None, "b", 5, None), (None, "c", 6, 3.0), ("", "d", 1, 4.0), ("", "e", 9, 5.0)],
                               "sender_id string, tx_id string, ts bigint, amount double")
    for hot_rows in (1, 2, 100):
        rows = lag_in_group(df, "sender_id", ["ts", "tx_id"], "amount", "prev", hot_rows).collect()
        assert {r.tx_id: r.prev for r in rows} == {"a": None, "b": 1.0, "c": None, "d": None, "e": 4.0}
    assert lag_in_group(df.limit(0), "sender_id", ["ts", "tx_id"], "amount", "prev").count() == 0
