"""Declarative data-quality rules evaluated as one aggregation.

The source pipeline runs one Spark job per check and raises on the first
failure.  Here the rules become rows ``(rule, severity, observed, passed)``
computed from one aggregate pass (row count, NULL keys) plus one grouped
pass (duplicate keys); the caller decides what a failure means
(``assert_passed`` raises like the original gate).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The columns the master table must provide.
REQUIRED_MASTER_COLUMNS = ("order_id", "order_status")


def _rule(name: str, severity: str, observed, passed):
    return F.struct(
        F.lit(name).alias("rule"),
        F.lit(severity).alias("severity"),
        observed.cast("bigint").alias("observed"),
        passed.alias("passed"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their multiplicity."""
    return df.groupBy(*keys).count().where(F.col("count") > 1)


def null_key_count(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count_if(F.col(key).isNull()).alias("null_keys"))


RULES = ("required_columns", "filled_columns", "non_empty", "null_keys", "duplicate_keys")


def dq_report(df: DataFrame, key: str | Sequence[str] = "order_id",
              required: Sequence[str] = REQUIRED_MASTER_COLUMNS, rules: Sequence[str] = RULES) -> DataFrame:
    """The chosen rules, one row each; only what they need is planned.

    ``required_columns`` counts required columns that the frame lacks,
    ``non_empty`` rows, ``null_keys`` rows with a NULL key column; these fail.
    ``filled_columns`` (required columns that it has but that hold no value in
    any of its rows) and ``duplicate_keys`` (an item-grain table legitimately
    repeats order keys) inform.  Key rules need all key columns and are left
    out without them.
    """
    keys = [key] if isinstance(key, str) else list(key)
    lost = [c for c in required if c not in df.columns]
    held = [c for c in required if c in df.columns]
    keyed = all(k in df.columns for k in keys)
    aggs = [F.count(F.lit(1)).alias("rows")]
    if "filled_columns" in rules:
        aggs += [F.count(F.col(f"`{c}`")).alias(f"_v{i}") for i, c in enumerate(held)]
    if "null_keys" in rules and keyed:
        aggs.append(F.count_if(~F.expr("true" if not keys else " AND ".join(f"`{k}` IS NOT NULL" for k in keys))).alias("null_keys"))
    stats, out = df.agg(*aggs), []
    if "required_columns" in rules:
        out.append(_rule("required_columns", "fail", F.lit(len(lost)), F.lit(not lost)))
    if "filled_columns" in rules:
        hollow = sum((((F.col("rows") > 0) & (F.col(f"_v{i}") == 0)).cast("int") for i in range(len(held))), F.lit(0))
        out.append(_rule("filled_columns", "info", hollow, hollow == 0))
    if "non_empty" in rules:
        out.append(_rule("non_empty", "fail", F.col("rows"), F.col("rows") > 0))
    if "null_keys" in rules and keyed:
        out.append(_rule("null_keys", "fail", F.col("null_keys"), F.col("null_keys") == 0))
    if "duplicate_keys" in rules and keyed:
        dups = duplicate_keys(df, keys).agg(F.count(F.lit(1))).scalar()
        out.append(_rule("duplicate_keys", "info", dups, F.lit(True)))
    return stats.select(F.inline(F.array(*out)))


def assert_passed(report: DataFrame) -> None:
    """Raise when any 'fail' rule did not pass (collects the few rule rows)."""
    failed = report.where((F.col("severity") == "fail") & ~F.col("passed")).collect()
    if failed:
        raise RuntimeError("data-quality failure: " + "; ".join(
            f"{r['rule']} observed {r['observed']}" for r in failed))
