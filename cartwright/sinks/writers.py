"""Writers: Parquet, CSV, JSON, report files, and the output contract.

Every output is published in two steps: it is written to a staging folder
beside its path, and takes the path's place by rename once it is complete (for
outputs with a contract: once its content is checked).  A job that fails
leaves the former output readable, and a retried one replaces it whole; a path
may be read by the job that replaces it.  Only report-grain results are
written as a single file.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.sources.fs import delete, file_exists, path_exists, rename


def _beside(path: str, what: str) -> str:
    """A fresh path in the same folder, hidden from readers of that folder."""
    parent, slash, name = path.rstrip("/").rpartition("/")
    return f"{parent}{slash}_{name}-{what}-{uuid.uuid4().hex}"


class Incomplete(RuntimeError):
    """A staged output lacks the marker of a finished job."""


def publish(spark: SparkSession, path: str, write: Callable[[str], None],
            check: Callable[[str], None] | None = None) -> None:
    """``write(staging)`` writes an output and ``check(staging)`` raises if it
    is not what it should be; then it takes the place of what is at ``path``.

    Whatever raises, the former output is at ``path`` afterwards and the
    staging folder is gone.  Two renames do the change; between them nothing is
    at ``path`` (file systems have no rename that replaces a folder)."""
    path = path.rstrip("/")
    staging, former = _beside(path, "staging"), _beside(path, "former")
    try:
        write(staging)
        if not file_exists(spark, f"{staging}/_SUCCESS"):
            raise Incomplete(f"{path}: no success marker in the staged output")
        if check:
            check(staging)
        held = path_exists(spark, path)
        if held:
            rename(spark, path, former)
        try:
            rename(spark, staging, path)
        except BaseException:
            if held:
                rename(spark, former, path)
            raise
    except BaseException:
        delete(spark, staging)
        raise
    if held:
        delete(spark, former)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet, published, optionally partitioned into directories."""
    publish(df.sparkSession, path, lambda staging: _parquet(df, staging, partition_by))


def _parquet(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Parquet, optionally partitioned into directories.

    A partitioned write first ``REBALANCE``s on the partition columns:
    without it every task writes a file into every partition directory it
    meets (tasks x partitions small files).  Rebalancing sends each
    directory's rows to one task, and AQE splits a skewed directory (a month
    holding a third of the data) across tasks and coalesces small ones.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_bucketed(df: DataFrame, path: str, table: str, key: str, buckets: int,
                   check: Callable[[str], None] | None = None) -> None:
    """Parquet files bucketed (hash-partitioned and sorted) on ``key``,
    published and registered as an external table ``table`` over ``path``.

    A later job that groups or joins on ``key`` reads the buckets as
    ready-made hash partitions and skips that shuffle; bucket files are
    plain Parquet for every other reader.
    """
    spark, staged = df.sparkSession, f"{table}_staging_{uuid.uuid4().hex}"

    def write(staging: str) -> None:
        try:
            df.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", staging).saveAsTable(staged)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {staged}")     # external: its files stay

    publish(spark, path, write, check)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    register_bucketed(spark, path, table, key, buckets)


def register_bucketed(spark, path: str, table: str, key: str, buckets: int) -> DataFrame:
    """Declare bucketed Parquet files written by another session (the
    bucket spec lives in the catalog, not in the files) and return the table."""
    if not spark.catalog.tableExists(table):
        fields = spark.read.parquet(path).schema.fields
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(
            f"CREATE TABLE {table} ({cols}) USING parquet "
            f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS "
            f"LOCATION '{path}'"
        )
    return spark.table(table)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Header CSV.  ``single_file`` funnels the data through one task, so it
    is for report-grain outputs only; array/map columns must be projected
    away first (CSV has no nested types)."""
    out = df.coalesce(1) if single_file else df
    publish(df.sparkSession, path, lambda staging: out.write.option("header", True).option("escape", '"').csv(staging))


def write_json(df: DataFrame, path: str) -> None:
    publish(df.sparkSession, path, df.write.json)


def write_report(df: DataFrame, root: str, name: str) -> str:
    """``<root>/<name>_report`` as one header CSV file (reports have one row
    per status / month / state / day)."""
    path = f"{root.rstrip('/')}/{name}_report"
    write_csv(df, path, single_file=True)
    return path


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """First ``n`` rows in the frame's own order (a top-n, not a full sort)."""
    return df.limit(n)


class ContractBroken(RuntimeError):
    """A written output does not hold what was to be written."""


def assert_contract(check: DataFrame) -> Row:
    """The one row of a contract check; raises if it did not pass."""
    row = check.first()
    if not row["passed"]:
        raise ContractBroken(f"{row['dataset']}: {row['written_rows']} of {row['expected_rows']} rows written, "
                             f"schema match {row['schema_match']}, content match {row['content_match']}, "
                             f"success marker {row['success_marker']}")
    return row


def _hashable(f: T.StructField) -> Column:
    """A column as its value is hashed: nested values as JSON, which has
    NULLs and the order of their parts."""
    col = F.col(f"`{f.name}`")
    return F.to_json(F.struct(col)) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)) else col


def content_aggs(fields: Sequence[T.StructField]) -> list[Column]:
    """What a set of rows holds, whatever their order: their number, and the
    sum and the exclusive or of their hashes (repeated rows count in the sum)."""
    cols = [_hashable(f) for f in sorted(fields, key=lambda f: f.name)]
    row = F.xxhash64(*cols, F.array(*[c.isNull() for c in cols]))       # the hash itself skips NULLs
    return [F.count(F.lit(1)).alias("rows"), F.sum(row.cast("decimal(38,0)")).alias("hash_sum"),
            F.bit_xor(row).alias("hash_xor")]


CONTRACT = ("dataset string, expected_rows bigint, written_rows bigint, schema_match boolean, content_match boolean, "
            "success_marker boolean, passed boolean")


def write_with_contract(df: DataFrame, path: str, name: str, partition_by: Sequence[str] = (),
                        write: Callable[[DataFrame, str], None] | None = None, buckets: tuple[str, str, int] | None = None,
                        ) -> DataFrame:
    """Write ``df`` as Parquet (bucketed as (table, key, buckets), or by
    ``write(df, path)``, whose output is Parquet too) and return the one row of
    its contract check.

    Row count and content (``content_aggs``) are observed while the output is
    written, without a job of their own; the staged output is read back and
    compared: row count, content, column set and types, and the ``_SUCCESS``
    marker of the job's commit.  It is published only if all agree; otherwise
    the former output stays and the row says what differs.
    """
    spark, fields = df.sparkSession, df.schema.fields
    observation = Observation(f"contract_{name}")
    observed = df.observe(observation, *content_aggs(fields))
    found: dict = {}

    def check(staging: str) -> None:
        expected, back = observation.get, spark.read.parquet(staging)
        want, got = {f.name: f.dataType for f in fields}, {f.name: f.dataType for f in back.schema.fields}
        same_schema = set(want) == set(got) and all(
            want[c].simpleString() == got[c].simpleString() or c in partition_by for c in want)
        shared = [f for f in fields if f.name in got]
        # folders have lost the types of partition columns
        typed = back.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) if f.name in partition_by
                              else F.col(f"`{f.name}`") for f in shared])
        written = typed.agg(*content_aggs(shared)).first().asDict()
        marker = file_exists(spark, f"{staging}/_SUCCESS")
        content = same_schema and written == {k: expected[k] for k in written}
        found.update(dataset=name, expected_rows=int(expected["rows"]), written_rows=int(written["rows"]),
                     schema_match=same_schema, content_match=content, success_marker=marker,
                     passed=same_schema and content and marker)
        if not found["passed"]:
            raise ContractBroken(name)

    try:
        if buckets:
            write_bucketed(observed, path, *buckets, check)
        else:
            publish(spark, path, lambda staging: (write or (lambda d, to: _parquet(d, to, partition_by)))(observed, staging),
                    check)
    except ContractBroken:
        if not found:
            raise
    return spark.createDataFrame([tuple(found.values())], CONTRACT)
