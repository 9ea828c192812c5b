"""Window operators over report-grain rows.

The report windows have no partition key: they run over one row per
status / state / month / day, a row count fixed by the calendar and the
number of groups rather than by the data volume, so the single-partition
exchange Spark plans for them moves a few thousand rows at any scale.
For row-level inputs use ``share_of_total`` (scalar-subquery total, no
single-partition window), ``dense_rank_distributed``, and ``prefix`` for lags,
running sums and moving averages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.functions.scalars import cents, half_up_ratio, tier_label


def _ordered(order_cols: list) -> Window:
    return Window.orderBy(*order_cols)


def share_of_total(df: DataFrame, value: str, name: str, is_money: bool = False,
                   scale: int = 2) -> DataFrame:
    """``value * 100 / sum(value)`` rounded HALF_UP; NULL when the total is 0.

    The total is a scalar subquery (a separate partial+final aggregate whose
    one-row result is inlined), so no row-level data funnels into a single
    partition.
    """
    unit = cents(value) if is_money else F.col(value)
    total = df.agg(F.sum(unit)).scalar()
    return (
        df.withColumns({"_share_v": unit, "_share_t": total})
        .withColumn(name, half_up_ratio(F.col("_share_v") * 100, "_share_t", scale))
        .drop("_share_v", "_share_t")
    )


def share_of_total_window(df: DataFrame, value: Column, name: str, scale: int = 2) -> DataFrame:
    """Same ratio as ``share_of_total`` with ``SUM() OVER ()`` as the
    denominator, for report-grain rows.  ``value`` must be integral."""
    return (
        df.withColumns({"_share_v": value, "_share_t": F.sum(value).over(Window.partitionBy())})
        .withColumn(name, half_up_ratio(F.col("_share_v") * 100, "_share_t", scale))
        .drop("_share_v", "_share_t")
    )


def lag_previous(value: str, order_col: str) -> Column:
    """Previous existing row's value (calendar gaps are not filled)."""
    return F.lag(value).over(_ordered([order_col]))


def growth_percentage(current_cents: Column, previous_cents: Column, scale: int = 2) -> Column:
    """(current - previous) * 100 / previous; NULL when previous is NULL or 0."""
    return half_up_ratio((current_cents - previous_cents) * 100, previous_cents, scale)


def dense_rank_desc(value: str) -> Column:
    """Dense rank, highest first; ties share a rank (no tie-breaker)."""
    return F.dense_rank().over(_ordered([F.col(value).desc()]))


def ntile_desc(n: int, value: str, tie_breaker: str) -> Column:
    """NTILE(n) highest first; larger buckets first.  The tie-breaker makes
    bucket membership deterministic when values tie."""
    return F.ntile(n).over(_ordered([F.col(value).desc(), F.col(tie_breaker).asc()]))


def performance_tier(quartile: str) -> Column:
    return tier_label(quartile)


def running_sum(value: str | Column, order_col: str) -> Column:
    v = F.col(value) if isinstance(value, str) else value
    return F.sum(v).over(_ordered([order_col]).rowsBetween(Window.unboundedPreceding, 0))


def _windowed_average(df: DataFrame, value_cents: Column, w: Window, name: str,
                      scale: int) -> DataFrame:
    return (
        df.withColumns({"_mv_s": F.sum(value_cents).over(w), "_mv_n": F.count(value_cents).over(w)})
        .withColumn(name, half_up_ratio("_mv_s", F.col("_mv_n") * 100, scale))
        .drop("_mv_s", "_mv_n")
    )


def moving_average_rows(df: DataFrame, value_cents: Column, order_col: str, name: str,
                        rows: int = 7, scale: int = 2) -> DataFrame:
    """Average of the current and ``rows - 1`` preceding *existing* rows,
    in money units, rounded HALF_UP from exact cents."""
    w = _ordered([order_col]).rowsBetween(-(rows - 1), 0)
    return _windowed_average(df, value_cents, w, name, scale)


def moving_average_days(df: DataFrame, value_cents: Column, date_col: str, name: str,
                        days: int = 7, scale: int = 2) -> DataFrame:
    """Calendar variant: rows whose date is within ``days - 1`` days before."""
    w = Window.orderBy(F.unix_date(F.col(date_col))).rangeBetween(-(days - 1), 0)
    return _windowed_average(df, value_cents, w, name, scale)


def dense_rank_distributed(df: DataFrame, value: str, name: str,
                           num_partitions: int | None = None) -> DataFrame:
    """``DENSE_RANK() OVER (ORDER BY value DESC)`` without a single-partition
    window, for an unbounded number of rows.

    Only the distinct values are ranked: reduced map-side, range-partitioned,
    highest first, and checkpointed to the shared folder, which fixes the
    ranges (a recomputed split could shift their bounds).  A value's place in
    its range plus the number of values in the ranges before it is its rank;
    one row per range is all that is gathered for the offsets.  The ranks are
    joined back to the rows, ``df`` itself being checkpointed so that it is
    computed once, by a join that AQE splits where one value (or NULL) holds
    many rows.  NULLs rank last, as in the window form.
    """
    from cartwright.session import checkpoint_root

    spark = df.sparkSession
    checkpoint_root(spark)
    n = int(num_partitions or spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.checkpoint()
    by_value = F.col("_value").desc_nulls_last()
    ranged = (
        rows.select(F.col(f"`{value}`").alias("_value")).distinct()
        .repartitionByRange(n, by_value)
        .withColumn("_range", F.spark_partition_id())
        .checkpoint()
    )
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_distinct"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_distinct").over(before), F.lit(0)).alias("_offset"))
    ranks = (
        ranged.withColumn("_place", F.row_number().over(Window.partitionBy("_range").orderBy(by_value)))
        .join(F.broadcast(offsets), "_range")            # at most ``n`` rows
        .select("_value", (F.col("_place") + F.col("_offset")).cast("int").alias(name))
    )
    return rows.join(ranks, F.col(f"`{value}`").eqNullSafe(F.col("_value"))).drop("_value")
