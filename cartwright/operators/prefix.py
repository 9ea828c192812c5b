"""Lags, running sums and moving averages over an unbounded number of rows.

A window without a partition key sends every row to one task.  Here the rows
are cut into ranges of the order, each range is worked on by itself, and what
it needs of the ranges before is handed to it: the totals before it (for
running sums) and their last rows (its halo, for lags and moving frames).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.functions.scalars import half_up_ratio
from cartwright.session import checkpoint_root


def _halos(sizes: list[int], reach: int) -> list[tuple[int, int, int]]:
    """(range, range that needs its last rows, how many of them): together the
    ``reach`` rows before each range, from as many ranges as that takes."""
    out = []
    for target, size in enumerate(sizes):
        wanted, k = reach if size else 0, target - 1
        while wanted > 0 and k >= 0:
            if take := min(wanted, sizes[k]):
                out.append((k, target, take))
            wanted, k = wanted - take, k - 1
    return out


def _totals_before(totals: list[dict], names: list[str]) -> list[tuple]:
    """(range, sum of each column in the ranges before it); NULL if they have
    no value."""
    out, sums = [], dict.fromkeys(names)
    for k, row in enumerate(totals):
        out.append((k, *sums.values()))
        for c in names:
            if row.get(c) is not None:
                sums[c] = row[c] if sums[c] is None else sums[c] + row[c]
    return out


def ordered_windows(df: DataFrame, order: Sequence[str], running_sums: Mapping[str, Column] | None = None,
                    lags: Mapping[str, tuple[Column, int]] | None = None,
                    moving_averages: Mapping[str, tuple[Column, int]] | None = None, scale: int = 2,
                    num_partitions: int | None = None) -> DataFrame:
    """``df`` with further columns, computed over all its rows in one order:

    - ``running_sums``: name -> value; its sum up to the row,
    - ``lags``: name -> (value, k); the value k rows before, NULL in the first k,
    - ``moving_averages``: name -> (whole cents, k); the average of the row and
      the k - 1 before it, in money units, rounded HALF_UP.

    ``order`` names columns, with a minus sign before one that descends; NULLs
    come first ascending, last descending.  Rows of equal order go by a hash of
    the whole row; rows that are equal in all columns are interchangeable.
    NULL values are left out of sums and averages, as in the window form.

    The rows are checkpointed, dealt to ranges of (order, hash, place in the
    checkpoint) and checkpointed again, which fixes the ranges: rows of one
    order value, and equal rows, spread over several as any others do.  A row a
    range comes to the driver: its size and its totals.
    """
    running_sums, lags, moving_averages = running_sums or {}, lags or {}, moving_averages or {}
    spark = df.sparkSession
    checkpoint_root(spark)
    n = int(num_partitions or spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(f"`{c}`") for c in df.columns]
    sums = {f"_s{k}": v for k, v in enumerate(running_sums.values())}
    back = {f"_l{k}": v for k, (v, _) in enumerate(lags.values())}
    means = {f"_m{k}": v for k, (v, _) in enumerate(moving_averages.values())}
    keys = {f"_o{k}": F.col(f"`{c.removeprefix('-')}`") for k, c in enumerate(order)}
    keyed = df.checkpoint().select(
        F.struct(*cols).alias("_row"), *[v.alias(c) for c, v in {**keys, **sums, **back, **means}.items()],
        F.xxhash64(*cols, F.array(*[c.isNull() for c in cols])).alias("_hash"),
        F.monotonically_increasing_id().alias("_place"))
    down = [c.startswith("-") for c in order] + [False, False]
    key_names = [*keys, "_hash", "_place"]
    by = [F.col(c).desc() if d else F.col(c).asc() for c, d in zip(key_names, down)]
    reverse = [F.col(c).asc() if d else F.col(c).desc() for c, d in zip(key_names, down)]
    ranged = keyed.repartitionByRange(n, *by).withColumn("_range", F.spark_partition_id()).checkpoint()

    per_range = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(c) for c in sums])
    found = {r["_range"]: r.asDict() for r in per_range.collect()}
    totals = [found.get(k, {"_n": 0}) for k in range(max(found, default=-1) + 1)]
    reach = max([k for _, k in lags.values()] + [k - 1 for _, k in moving_averages.values()], default=0)
    rows = ranged.withColumn("_halo", F.lit(False))
    if halos := _halos([t["_n"] for t in totals], reach):
        given = spark.createDataFrame(halos, "_from int, _to int, _take int")      # at most ``reach`` for each range
        tails = ranged.withColumn("_n", F.row_number().over(Window.partitionBy("_range").orderBy(*reverse))).where(
            F.col("_n") <= reach)
        rows = rows.unionByName(
            tails.join(F.broadcast(given), (F.col("_range") == F.col("_from")) & (F.col("_n") <= F.col("_take")))
            .drop("_range", "_n", "_from", "_take").withColumnRenamed("_to", "_range").withColumn("_halo", F.lit(True)))

    here = Window.partitionBy("_range").orderBy(*by)
    so_far = here.rowsBetween(Window.unboundedPreceding, 0)
    made = {f"_w{c}": F.sum(F.when(~F.col("_halo"), F.col(c))).over(so_far) for c in sums}
    made |= {f"_w{c}": F.lag(c, k).over(here) for c, (_, k) in zip(back, lags.values())}
    for c, (_, width) in zip(means, moving_averages.values()):
        frame = here.rowsBetween(1 - width, 0)
        made |= {f"_w{c}": F.sum(c).over(frame), f"_n{c}": F.count(c).over(frame)}
    done = rows.withColumns(made).where("NOT _halo")
    if sums:
        schema = T.StructType([T.StructField("_at", T.IntegerType()), *[
            T.StructField(f"_b{c}", per_range.schema[c].dataType) for c in sums]])
        before = spark.createDataFrame(_totals_before(totals, list(sums)), schema)
        done = done.join(F.broadcast(before), F.col("_range") == F.col("_at"))     # a row a range
    return done.select(
        "_row.*",
        *[F.coalesce(F.col(f"_w{c}") + F.col(f"_b{c}"), f"_w{c}", f"_b{c}").alias(name) for name, c in zip(running_sums, sums)],
        *[F.col(f"_w{c}").alias(name) for name, c in zip(lags, back)],
        *[half_up_ratio(f"_w{c}", F.col(f"_n{c}") * 100, scale).alias(name) for name, c in zip(moving_averages, means)])
