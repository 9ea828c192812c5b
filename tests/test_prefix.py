"""Prefix scans and the distributed rank against their window forms."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwright.functions.scalars import half_up_ratio
from cartwright.operators.prefix import _halos, ordered_windows
from cartwright.operators.windows import dense_rank_distributed

SCHEMA = "id int, day int, v decimal(12,2), c bigint"


def _table(spark, n, days, seed=1):
    rnd = random.Random(seed)
    return spark.createDataFrame([
        (i, rnd.choice(days), None if rnd.random() < 0.2 else Decimal(rnd.randrange(-500, 500)) / 100,
         None if rnd.random() < 0.2 else rnd.randrange(-500, 500)) for i in range(n)], SCHEMA)


def _windows(df, by):
    cols = [F.col(c) for c in df.columns]
    w = Window.orderBy(*by, F.xxhash64(*cols, F.array(*[c.isNull() for c in cols])))
    seven = w.rowsBetween(-6, 0)
    return df.select("*", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("total"),
                     F.lag("v", 3).over(w).alias("third_last"),
                     half_up_ratio(F.sum("c").over(seven), F.count("c").over(seven) * 100, 2).alias("mean"))


def _scan(df, order, n):
    return ordered_windows(df, order, running_sums={"total": F.col("v")}, lags={"third_last": (F.col("v"), 3)},
                           moving_averages={"mean": (F.col("c"), 7)}, num_partitions=n)


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("ranges", [1, 4, 60])
@pytest.mark.parametrize("days", [[3], [None, *range(5)], range(10_000)])
def test_ordered_windows_equal_the_window_form(spark, ranges, days):
    """Few and many ties, all rows of one order value, ranges shorter than
    the frame (60 ranges of 90 rows)."""
    df = _table(spark, 90, days)
    assert _sorted(_scan(df, ["day"], ranges)) == _sorted(_windows(df, [F.col("day")]))
    got = _scan(df, ["-day", "id"], ranges)
    assert _sorted(got) == _sorted(_windows(df, [F.col("day").desc(), F.col("id")]))


def test_repeated_rows_and_empty_tables(spark):
    one = spark.createDataFrame([(1, 1, Decimal("2.00"), 3)] * 40 + [(2, None, None, None)], SCHEMA)
    assert _sorted(_scan(one, ["day"], 8)) == _sorted(_windows(one, [F.col("day")]))
    assert _scan(one.limit(0), ["day"], 8).collect() == []
    assert _scan(one.limit(0), ["day"], 8).columns == ["id", "day", "v", "c", "total", "third_last", "mean"]


def test_no_task_gathers_all_rows(spark):
    """No single-partition exchange; one order value spreads over the ranges."""
    df = _table(spark, 2000, [7])
    out = _scan(df, ["day"], 8)
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = [r["count"] for r in _scan(df, ["day"], 8).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(spread) < 1600 and sum(spread) == 2000


def test_halos_reach_over_short_ranges():
    assert _halos([5, 1, 0, 2, 4], 3) == [(0, 1, 3), (1, 3, 1), (0, 3, 2), (3, 4, 2), (1, 4, 1)]
    assert _halos([5, 5], 0) == [] and _halos([], 3) == []


@pytest.mark.parametrize("hot", [None, 41])
def test_a_hot_value_is_split_when_ranks_are_joined_back(spark, hot):
    """A third of the rows hold one value or NULL: no task holds them all."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    old = {k: spark.conf.get(k) for k in conf}
    df = spark.range(0, 60_000, numPartitions=8).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.col("id") % 40).cast("int").alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    want = {r["v"]: r["r"] for r in df.select("v").distinct().select(
        "v", F.dense_rank().over(Window.orderBy(F.col("v").desc_nulls_last())).alias("r")).collect()}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        ranked = dense_rank_distributed(df, "v", "r", num_partitions=4)
        got = ranked.withColumn("p", F.spark_partition_id()).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(got) == 60_000 and all(want[g["v"]] == g["r"] for g in got)
    tasks = {}
    for g in got:
        tasks[g["p"]] = tasks.get(g["p"], 0) + (g["v"] == hot)
    assert max(tasks.values()) < 20_000
