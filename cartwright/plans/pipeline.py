"""End-to-end jobs: profile, transform, quality gate, reports.

These are the user-facing entry points of the source pipeline, each a thin
driver around the lazy operators: it picks inputs, persists what is read
more than once, writes with ``overwrite`` and returns what it wrote.
"""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cartwright.operators import profile as P
from cartwright.operators import quality as Q
from cartwright.plans.analytics import (
    analytics_orders, master_from_tables, orders_summary, register_views,
)
from cartwright.plans.reports import REPORTS
from cartwright.plans.sql_runner import PACKAGED_SQL, run_sql_files
from cartwright.sinks import writers as K
from cartwright.sources import readers as S
from cartwright.sources.adapters import CommerceTables, load_commerce
from cartwright.sources.schemas import COUNTED_SOURCES, EXPECTED_COLUMNS, RAW_FILES, RAW_SCHEMAS


class RawCsvTables:
    """Source tables read from a raw CSV drop (typed, tolerant, bound by
    header).  ``null_tokens`` are the texts read as NULL: none for the
    transform, ``readers.NULL_TOKENS`` for the profile."""

    def __init__(self, spark: SparkSession, raw_dir: str, file_names: dict[str, str] | None = None,
                 null_tokens: tuple[str, ...] = ()):
        self.spark, self.raw_dir, self.file_names = spark, raw_dir.rstrip("/"), file_names
        if unknown := set(file_names or ()) - set(RAW_FILES):
            raise ValueError(f"no source table is called {sorted(unknown)}; known: {sorted(RAW_FILES)}")
        self.scans = S.tolerant_scans(
            spark, {name: f"{self.raw_dir}/{fname}" for name, fname in {**RAW_FILES, **(file_names or {})}.items()},
            RAW_SCHEMAS, null_tokens=null_tokens)

    def for_profile(self) -> RawCsvTables:
        return RawCsvTables(self.spark, self.raw_dir, self.file_names, S.NULL_TOKENS)

    def __getattr__(self, name: str) -> DataFrame:
        scans = self.__dict__.get("scans", {})
        if name not in scans:
            raise AttributeError(name)
        scan = scans[name]
        if scan.frame is None:
            raise FileNotFoundError(f"{name}: {scan.status} ({scan.message})")
        return scan.frame.drop(S.CORRUPT)

    def as_dict(self) -> dict[str, DataFrame]:
        return {n: s.frame.drop(S.CORRUPT) for n, s in self.scans.items() if s.frame is not None}

    def statuses(self) -> dict[str, str]:
        return {n: s.status for n, s in self.scans.items()}


def open_inputs(spark: SparkSession, raw_dir: str | None = None, tables_dir: str | None = None,
                file_names: dict[str, str] | None = None) -> CommerceTables | RawCsvTables:
    if raw_dir:
        return RawCsvTables(spark, raw_dir, file_names)
    if tables_dir:
        return load_commerce(spark, tables_dir)
    raise ValueError("give raw_dir (CSV drop) or tables_dir (parquet test tables)")


def _profile_scan(spark: SparkSession, name: str, scan: S.ScanResult) -> DataFrame:
    """A table's profile; the row of a table that could not be read says why."""
    status, message = scan.status, scan.message
    if scan.frame is not None:
        try:
            return P.profile_table(scan.with_texts, name, EXPECTED_COLUMNS[name], True, scan.header, S.CORRUPT, S.TEXTS).select(
                "*", F.lit(status).alias("status"), F.lit(message).alias("message"),
                *[F.array(*[F.lit(c) for c in found]).cast("array<string>").alias(label) for label, found in (
                    ("partial_columns", scan.partial_columns), ("duplicate_columns", scan.duplicate_columns))],
                F.lit(len(scan.heads.groups)).alias("header_groups"), F.lit(len(scan.heads.empty)).alias("empty_files"))
        except (PySparkException, Py4JJavaError) as err:    # a file that breaks while it is read
            status, message = "unreadable", str(err).splitlines()[0]
    return spark.range(1).select(F.lit(name).alias("table_name"), F.lit(status).alias("status"),
                                 F.lit(message).alias("message"))


def profile_job(inputs, out_path: str) -> DataFrame:
    """Profile every source table and write the profile as JSON: a row for
    each, with its status, what the headers lack or have besides, and the rows
    that the CSV parser could not fit; tables that are missing, empty or
    unreadable have a row too, and leave the others as they are.  Each table is
    read once.  Returns the written profile."""
    if isinstance(inputs, RawCsvTables):
        spark = inputs.spark
        frames = [_profile_scan(spark, name, scan) for name, scan in inputs.for_profile().scans.items()]
    else:
        tables = inputs.as_dict()
        spark = next(iter(tables.values())).sparkSession
        frames = [P.profile_table(df, name, EXPECTED_COLUMNS[name], True).withColumn("status", F.lit("loaded"))
                  for name, df in tables.items()]
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.unionByName(f, allowMissingColumns=True)
    K.write_json(whole, out_path)
    return spark.read.schema(whole.schema).json(out_path)


@dataclass
class TransformResult:
    master_path: str
    summary_path: str
    source_rows: dict[str, int]
    master_rows: int


MASTER_TABLE = "master_orders"

# Sources the master build consumes; their row counts are observed during it.
MASTER_INPUTS = ("orders", "order_items", "customers", "payments")


def transform_job(inputs, out_dir: str, partition_by: tuple[str, ...] = (),
                  buckets: int | None = None) -> TransformResult:
    """Build the master table; write it as Parquet and the order summary as
    CSV.  Row counts of the master's inputs are observed while the master is
    computed (no separate count jobs over the large tables); the master is
    persisted once for its two writes.  With ``buckets`` the master is
    bucketed on ``order_id`` (table ``master_orders``), so the reports job's
    order-level dedup reads co-located buckets instead of shuffling.  Either
    way the written table is read back and its content checked before it takes
    the former one's place; ``ContractBroken`` is raised if it does not hold
    what was written, and the former master stays."""
    out_dir = out_dir.rstrip("/")
    observations, observed = {}, {}
    for name in MASTER_INPUTS:
        obs = Observation(f"rows_{name}")
        observations[name] = obs
        observed[name] = getattr(inputs, name).observe(obs, F.count(F.lit(1)).alias("rows"))
    master = master_from_tables(_Observed(observed, inputs)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        master_path, summary_path = f"{out_dir}/master_orders", f"{out_dir}/orders_summary"
        contract = K.assert_contract(K.write_with_contract(
            master, master_path, "master_orders", partition_by,
            buckets=(MASTER_TABLE, "order_id", buckets) if buckets else None))
        K.write_csv(orders_summary(master).drop("payment_types"), summary_path)
    finally:
        master.unpersist()
    # Observation.get blocks until the observed plan has run: only ask for
    # inputs the master build executed.  Products feed no output here, so
    # their count is its own (small) job.
    rows = {name: int(obs.get["rows"]) for name, obs in observations.items()}
    for name in COUNTED_SOURCES:
        if name not in rows:
            rows[name] = getattr(inputs, name).count()
    return TransformResult(master_path, summary_path, rows, int(contract["written_rows"]))


class _Observed:
    def __init__(self, observed: dict[str, DataFrame], inputs):
        self._observed, self._inputs = observed, inputs

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self._observed.get(name) or getattr(self._inputs, name)


def quality_job(spark: SparkSession, master_path: str, buckets: int | None = None) -> DataFrame:
    """Evaluate the master-table rules; raise if a 'fail' rule fails."""
    report = Q.dq_report(read_master(spark, master_path, buckets), "order_id")
    Q.assert_passed(report)
    return report


def read_master(spark: SparkSession, master_path: str, buckets: int | None = None) -> DataFrame:
    if buckets:
        return K.register_bucketed(spark, master_path, MASTER_TABLE, "order_id", buckets)
    return spark.read.parquet(master_path)


def reports_job(spark: SparkSession, master_path: str, reports_dir: str,
                buckets: int | None = None) -> dict[str, str]:
    """Read the master, cache the analytics relation once, register the SQL
    views and write every report as a single header CSV.  Pass the
    transform's ``buckets`` to read a bucketed master shuffle-free."""
    master = read_master(spark, master_path, buckets)
    analytics = analytics_orders(master).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        register_views(spark, analytics)
        return {name: K.write_report(fn(analytics), reports_dir, name) for name, fn in REPORTS.items()}
    finally:
        analytics.unpersist()


def sql_job(spark: SparkSession, master_path: str, out_dir: str, sql_dir: str | None = None,
            buckets: int | None = None) -> dict[str, str]:
    """Run a folder of SQL files (the packaged ones by default) over the
    analytics views and write each result as a header CSV."""
    analytics = analytics_orders(read_master(spark, master_path, buckets)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        found = run_sql_files(spark, analytics, sql_dir or PACKAGED_SQL)
        return {name: K.write_report(df, out_dir, name) for name, df in found.items()}
    finally:
        analytics.unpersist()
