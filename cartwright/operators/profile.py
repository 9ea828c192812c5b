"""Distributed table profiling.

The source pipeline profiles each table in one pandas process.  Here every
metric is an executor-side aggregate.  A profile reads its table once: the row
count and, per column, the NULL count, logical byte size and the type that its
values' text fits are observed while a hash of every row is written; only where
hashes repeat is the table read again, for the rows that a sketch of these
hashes lets through.  Results are small long-format frames (one row per table
or per column).
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.functions.scalars import half_up_ratio
from cartwright.operators.widening import text_fits, widens_to
from cartwright.session import scratch_path

# Bytes per non-NULL value of fixed-width types.
FIXED_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4,
    T.FloatType: 4, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8,
    T.TimestampNTZType: 8,
}


def value_bytes(c: str, dtype: T.DataType) -> Column:
    """Logical size of one value: UTF-8 bytes for text, the fixed width
    otherwise; NULL counts as 0.  (Not comparable with pandas' object
    overhead, which measures Python objects rather than data.)"""
    col = F.col(c)
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        size = F.octet_length(col)
    elif isinstance(dtype, T.DecimalType):
        size = F.when(col.isNotNull(), F.lit(8 if dtype.precision <= 18 else 16))
    elif type(dtype) in FIXED_WIDTH:
        size = F.when(col.isNotNull(), F.lit(FIXED_WIDTH[type(dtype)]))
    else:
        size = F.octet_length(F.to_json(F.struct(col)))
    return F.coalesce(size.cast("bigint"), F.lit(0).cast("bigint"))


# What a value's text must look like for each inferred type, in
# the order in which the types are tried.
INFERRED = (
    ("bigint", r"^[+-]?[0-9]{1,18}$"),
    ("double", r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"),
    ("timestamp", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?)?$"),
    ("boolean", r"^([tT][rR][uU][eE]|[fF][aA][lL][sS][eE])$"),
)


def _fits(f: T.StructField, col: Column | None = None) -> Column:
    """Bits of the types in ``INFERRED`` that a value's text fits.  What the
    text of integers, decimals, dates, timestamps and booleans looks like is
    known, so only text and floating-point values are matched."""
    c, bit = F.col(f"`{f.name}`") if col is None else col, {name: 1 << k for k, (name, _) in enumerate(INFERRED)}
    if isinstance(f.dataType, T.IntegralType):
        return F.when(F.abs(c.cast("decimal(20,0)")) < F.lit(10 ** 18).cast("decimal(20,0)"),
                      F.lit(bit["bigint"] | bit["double"])).otherwise(F.lit(bit["double"]))
    if isinstance(f.dataType, T.DecimalType) and f.dataType.scale > 0:
        return F.lit(bit["double"])
    if isinstance(f.dataType, T.BooleanType):
        return F.lit(bit["boolean"])
    if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.when(F.year(c).between(0, 9999), F.lit(bit["timestamp"])).otherwise(F.lit(0))
    text, flags = c.cast("string"), F.lit(0)
    for name, pattern in INFERRED:
        flags = flags + F.when(text.rlike(pattern), F.lit(bit[name])).otherwise(F.lit(0))
    return flags


def _inferred(bits: Column) -> Column:
    kind = F.lit("string")
    for k, (name, _) in reversed(list(enumerate(INFERRED))):
        kind = F.when(bits.bitwiseAND(F.lit(1 << k)) != 0, F.lit(name)).otherwise(kind)
    return F.when(bits.isNull(), F.lit("void")).otherwise(kind)


def _stat_aggs(fields: list[T.StructField], infer: bool, texts: str | None = None) -> list[Column]:
    """Aggregates of a table's statistics, one column each.  With ``texts``, a
    struct of the fields' texts as their files have them, types are inferred
    from these, and values whose text does not fit the field's type counted."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, f in enumerate(fields):
        col = F.col(f"`{f.name}`")
        aggs.append(F.count_if(col.isNull()).alias(f"_n{i}"))
        aggs.append(F.sum(value_bytes(f.name, f.dataType)).alias(f"_b{i}"))
        text = F.col(f"{texts}.`{f.name}`") if texts else None
        if infer:
            # a bit for each type that a value fits; those that all values fit remain
            value = T.StructField(f.name, T.StringType()) if texts else f
            aggs.append(F.bit_and(F.when((text if texts else col).isNotNull(), _fits(value, text))).alias(f"_t{i}"))
        if texts:
            aggs.append(F.count_if(text.isNotNull() & ~text_fits(text, f.dataType)).alias(f"_x{i}"))
    return aggs


def _stat_rows(one: DataFrame, fields: list[T.StructField], table_name: str, infer: bool) -> DataFrame:
    """One row per column from the one row of ``_stat_aggs``."""
    per_col = F.array(*[
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            (_inferred(F.col(f"_t{i}")) if infer else F.lit(None).cast("string")).alias("inferred_type"),
            F.col(f"_n{i}").alias("null_count"),
            F.coalesce(F.col(f"_b{i}"), F.lit(0).cast("bigint")).alias("logical_bytes"),
        )
        for i, f in enumerate(fields)
    ])
    return (
        one.select(F.col("_rows").alias("row_count"), F.inline(per_col))
        .select(
            F.lit(table_name).alias("table_name"), "position", "column_name", "data_type",
            "inferred_type", "row_count", "null_count",
            half_up_ratio(F.col("null_count") * 100, "row_count", 2).alias("null_percentage"),
            "logical_bytes",
        )
    )


def column_stats(df: DataFrame, table_name: str, infer: bool = True) -> DataFrame:
    """One row per column: table_name, position, column_name, data_type
    (declared), inferred_type, row_count, null_count, null_percentage,
    logical_bytes.  One scan.

    ``inferred_type`` comes from the values: the first type that the text of
    every non-NULL value fits, else string; void where all are NULL.  Without
    ``infer`` it is NULL."""
    fields = df.schema.fields
    return _stat_rows(df.agg(*_stat_aggs(fields, infer)), fields, table_name, infer)


# Bits of the sketch of repeated hashes: for each of them, at least and at most.
SKETCH_PER_HASH, SKETCH_LEAST, SKETCH_MOST = 32, 1 << 10, 1 << 26


def _sketch_of(repeated: DataFrame) -> Column:
    """A bitmap, as one array of 64-bit words, in which the bit of every hash
    in the column ``_hash`` is set.  Its size is the power of two next above
    ``SKETCH_PER_HASH`` bits a hash; beyond ``SKETCH_MOST`` bits (8 MB) more
    rows pass it, and results stay the same."""
    wanted = F.pow(F.lit(2.0), F.ceil(F.log2(F.count(F.lit(1)) * SKETCH_PER_HASH + 1.0)))
    size = repeated.agg(F.least(F.greatest(wanted, F.lit(SKETCH_LEAST)), F.lit(SKETCH_MOST)).cast("bigint").alias("bits"))
    bit = F.pmod("_hash", size.scalar())
    marked = repeated.select(F.shiftright(bit, 6).alias("word"),
                             F.call_function("shiftleft", F.lit(1).cast("bigint"), bit.bitwiseAND(63).cast("int")).alias("v"))
    zeros = size.select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.shiftright("bits", 6) - 1)).alias("word"),
                        F.lit(0).cast("bigint").alias("v"))
    words = marked.union(zeros).groupBy("word").agg(F.bit_or("v").alias("v")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("word", "v"))), lambda x: x["v"]).alias("words"))
    return words.scalar()


def _in_sketch(hashed: Column, words: Column) -> Column:
    bit = F.pmod(hashed, F.size(words).cast("bigint") * 64)
    return F.getbit(F.get(words, F.shiftright(bit, 6).cast("int")), bit.bitwiseAND(63).cast("int")) == 1


def _repeated(hashes: DataFrame) -> DataFrame:
    return hashes.groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select("_hash")


def duplicate_row_count(df: DataFrame, row_hash: Callable[[list[str]], Column] | None = None,
                        hashes: DataFrame | None = None) -> DataFrame:
    """One row: rows beyond the first of each group of identical rows (NULLs
    compare equal, as in GROUP BY).  Exact, in two phases.

    First rows are counted by a 64-bit hash of the row (combined map-side, so
    8 bytes and a count are shuffled).  The hashes that more than one row has
    go into a bitmap, which every task gets as a value: rows whose bit is not
    set are unique for certain and never leave their scan; only the others are
    grouped by all their columns.  ``row_hash`` replaces the hash in tests;
    ``hashes`` are the rows' hashes (``_hash``) where they are at hand.
    """
    hashed = (row_hash or _row_hash)(df.columns)
    words = _sketch_of(_repeated(df.select(hashed.alias("_hash")) if hashes is None else hashes))
    groups = df.where(_in_sketch(hashed, words)).groupBy(*[f"`{c}`" for c in df.columns]).agg(
        F.count(F.lit(1)).alias("_copies"))
    return groups.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def _row_hash(columns: list[str]) -> Column:
    # xxhash64 skips NULLs, so their positions are hashed too
    cols = [F.col(f"`{c}`") for c in columns]
    return F.xxhash64(*cols, F.array(*[c.isNull() for c in cols]))


def schema_diff(columns: list[str], expected: list[str]) -> tuple[bool, list[str], list[str]]:
    """(valid, missing, extra): missing columns invalidate, extras inform."""
    missing = sorted(set(expected) - set(columns))
    extra = sorted(set(columns) - set(expected))
    return (not missing, missing, extra)


#: Per-column maps of the profile document: statistic, name of the map.
COLUMN_MAPS = (("data_type", "data_types"), ("inferred_type", "inferred_types"), ("null_count", "null_counts"),
               ("null_percentage", "null_percentages"))


@dataclass(frozen=True)
class TablePass:
    """What one scan of a table gave: a row of statistics, and the hash of
    each row, written to the shared folder."""
    stats: DataFrame
    hashes: DataFrame
    corrupt_rows: int
    repeats: bool
    misfits: dict[str, int]     # column: values whose text does not fit its type


def scan_once(df: DataFrame, infer: bool, corrupt: str | None = None, texts: str | None = None) -> TablePass:
    """Reads the table once, in a job of its own: statistics and the number of
    rows whose column ``corrupt`` is filled are observed while the row hashes
    are written.  ``texts`` is a struct of the columns' texts, where they came
    from text.  A second small job finds whether any hash repeats."""
    spark = df.sparkSession
    data = [f for f in df.schema.fields if f.name not in (corrupt, texts)]
    aggs = _stat_aggs(data, infer, texts)
    if corrupt:
        aggs.append(F.count(f"`{corrupt}`").alias("_corrupt"))
    observation, path = Observation(), scratch_path(spark, "row-hashes")
    df.observe(observation, *aggs).select(_row_hash([f.name for f in data]).alias("_hash")).write.parquet(path)
    found = observation.get
    hashes = spark.read.schema("_hash bigint").parquet(path)
    stats = spark.range(1).select(*[F.lit(v).cast("bigint" if k[1] != "t" else "int").alias(k)
                                    for k, v in found.items() if k != "_corrupt"])
    misfits = {f.name: n for i, f in enumerate(data) if (n := found.get(f"_x{i}"))}
    return TablePass(stats, hashes, int(found.get("_corrupt") or 0), not _repeated(hashes).isEmpty(), misfits)


def profile_table(df: DataFrame, table_name: str, expected: list[str] | None = None,
                  columns: bool = False, found: list[str] | None = None, corrupt: str | None = None,
                  texts: str | None = None) -> DataFrame:
    """One summary row: shape, NULL cells, logical bytes, duplicate rows and
    schema validity against ``expected`` column names; with ``columns`` also
    the per-column maps of ``COLUMN_MAPS``; with ``corrupt``, a column that is
    no part of the data, the number of rows where it is filled; with ``texts``,
    a struct of the columns' texts, types are inferred from these, and
    ``misfits`` has the number of values that do not fit their column's type,
    by column.  ``found`` are the names that the source itself has (a CSV's
    header) where ``df`` was given others.  The table is read by ``scan_once`` while the profile is
    built, and once more only if row hashes repeat."""
    def by_column(c: str) -> Column:
        pairs = F.array_sort(F.collect_list(F.struct("position", F.struct("column_name", c).alias("kv"))))
        return F.map_from_entries(F.transform(pairs, lambda p: F.struct(p["kv"]["column_name"], p["kv"][c])))

    once = scan_once(df, columns, corrupt, texts)
    data = df.drop(*[c for c in (corrupt, texts) if c])
    stats = _stat_rows(once.stats, data.schema.fields, table_name, columns).groupBy("table_name").agg(
        F.max("row_count").alias("row_count"),
        F.count(F.lit(1)).alias("column_count"),
        F.sum("null_count").alias("null_cells"),
        F.sum("logical_bytes").alias("logical_bytes"),
        *([by_column(c).alias(name) for c, name in COLUMN_MAPS] if columns else []),
    )
    valid, missing, extra = schema_diff(found or data.columns, expected if expected is not None else data.columns)
    dups = duplicate_row_count(data, hashes=once.hashes).scalar() if once.repeats else F.lit(0)
    return stats.select(
        "table_name",
        F.col("row_count").cast("bigint").alias("row_count"),
        F.col("column_count").cast("bigint").alias("column_count"),
        F.lit(",".join(data.columns)).alias("column_names"),
        F.col("null_cells").cast("bigint").alias("null_cells"),
        F.col("logical_bytes").cast("bigint").alias("logical_bytes"),
        dups.cast("bigint").alias("duplicate_rows"),
        F.lit(valid).alias("schema_valid"),
        F.array(*[F.lit(c) for c in missing]).cast("array<string>").alias("missing_columns"),
        F.array(*[F.lit(c) for c in extra]).cast("array<string>").alias("extra_columns"),
        *([name for _, name in COLUMN_MAPS] if columns else []),
        *([F.lit(once.corrupt_rows).cast("bigint").alias("corrupt_rows")] if corrupt else []),
        *([F.from_json(F.lit(json.dumps(once.misfits)), "map<string,bigint>").alias("misfits")] if texts else []),
    )


def schema_check(df: DataFrame, table_name: str, expected: list[str], found: list[str] | None = None,
                 types: T.StructType | None = None, texts: str | None = None) -> DataFrame:
    """Row count plus the column-name check, without the full profile.  With
    ``types`` also the type check: ``types_valid`` and ``type_mismatches``, for
    each column of these types whose values need a wider one both types and, for
    text, the number of values that do not fit.  Text columns (or the struct
    ``texts`` of the columns' texts) are checked by their values, others by
    their type.  One scan."""
    data = [f for f in df.schema.fields if f.name != texts]
    valid, missing, extra = schema_diff(found or [f.name for f in data], expected)
    aggs, needs = [F.count(F.lit(1)).alias("row_count")], []
    held = {f.name: f.dataType for f in data}
    for i, f in enumerate(f for f in (types or T.StructType()).fields if f.name in held):
        said = f"{f.name}: {f.dataType.simpleString()}, "
        if texts or isinstance(held[f.name], T.StringType):
            text = F.col(f"{texts}.`{f.name}`") if texts else F.col(f"`{f.name}`")
            aggs += [F.bit_and(F.when(text.isNotNull(), _fits(T.StructField(f.name, T.StringType()), text))).alias(f"_t{i}"),
                     F.count_if(text.isNotNull() & ~text_fits(text, f.dataType)).alias(f"_x{i}")]
            needs.append(F.when(F.col(f"_x{i}") > 0, F.concat(
                F.lit(said), F.col(f"_x{i}").cast("string"), F.lit(" values need "), _inferred(F.col(f"_t{i}")))))
        elif not widens_to(held[f.name], f.dataType):
            needs.append(F.lit(f"{said}values need {held[f.name].simpleString()}"))
    mismatches = F.array_compact(F.array(*needs)) if needs else F.array().cast("array<string>")
    return df.agg(*aggs).select(
        F.lit(table_name).alias("table_name"),
        "row_count",
        F.lit(len(data)).cast("bigint").alias("column_count"),
        F.lit(valid).alias("schema_valid"),
        F.array(*[F.lit(c) for c in missing]).cast("array<string>").alias("missing_columns"),
        F.array(*[F.lit(c) for c in extra]).cast("array<string>").alias("extra_columns"),
        *([(F.size(mismatches) == 0).alias("types_valid"), mismatches.alias("type_mismatches")] if types else []),
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def profile_tables(tables: dict[str, DataFrame], expected: dict[str, list[str]], columns: bool = False,
                   found: dict[str, list[str]] | None = None) -> DataFrame:
    return union_all([profile_table(df, name, expected.get(name), columns, (found or {}).get(name))
                      for name, df in tables.items()])
