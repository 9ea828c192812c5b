import random

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as E
from cartwright.plans.catalog import CATALOG
from cartwright.operators.windows import dense_rank_distributed, share_of_total
from support import SF_SMALL

ROWS_ONLY: set[str] = set()
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["customer_state", "total_orders", "total_customers"]


def test_every_query_has_an_oracle_unless_rows_only():
    sql = E.oracle_sql()
    assert set(CATALOG) - set(sql) == ROWS_ONLY
    assert set(CATALOG) <= set(E.queries()) and set(sql) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if v.__class__.__name__ == "Decimal":
        return repr(float(v))
    return v


def _canon(cols, rs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rs), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


SPOT = ["order_status_report", "monthly_revenue_report", "state_performance_report",
        "running_revenue_report", "delivery_analysis_report", "build_master", "dedup_order_lines",
        "seller_performance", "profile_json", "dq_report", "share_of_total", "schema_resolve",
        "csv_header_binding", "text_profile", "input_completeness", "tolerant_scan", "column_types",
        "run_reports", "sql_file_reports", "orders_summary_csv", "duplicate_rows", "item_master"]


@pytest.mark.parametrize("key", SPOT)
def test_matches_duckdb_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    res = duck.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(dcols, res.fetchall())


def test_dense_rank_distributed_matches_window(spark):
    rnd = random.Random(7)
    data = [(i, rnd.choice([None, *range(40)])) for i in range(500)]
    df = spark.createDataFrame(data, "id int, v int")
    want = {r["id"]: r["r"] for r in df.select(
        "id", F.dense_rank().over(Window.orderBy(F.col("v").desc_nulls_last())).alias("r")).collect()}
    got = {r["id"]: r["r"] for r in dense_rank_distributed(df, "v", "r", num_partitions=5).collect()}
    assert got == want


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_products_anywhere(spark):
    for key, fn in CATALOG.items():
        if key in ROWS_ONLY or "roundtrip" in key or key in (
                "output_contract", "empty_fields", "tolerant_scan", "profile_json", "input_completeness",
                "text_profile", "csv_header_binding", "orders_summary_csv"):
            continue
        plan = _plan(fn(spark, SF_SMALL))
        assert "CartesianProduct" not in plan, key
        assert "BroadcastNestedLoopJoin" not in plan, key


def test_scan_pruning_and_pushdown(spark):
    df = E.queries()["late_flag"](spark, SF_SMALL)
    plan = _plan(df)
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").where(F.col("l_returnflag") == "R") \
        .select("l_orderkey")
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in _plan(li)


def test_row_level_share_has_no_single_partition_window(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    plan = _plan(share_of_total(df, "v", "pct", scale=4))
    assert "SinglePartition" not in plan.split("Subquery")[0]


def _single_partition_inputs(plan: str):
    """Operator names directly below each single-partition exchange."""
    lines = plan.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            for ln in lines[i + 1:]:
                op = ln.strip().lstrip("+-:* ").split("(")[0].split(" ")[0]
                if op and op not in ("Project", "Filter"):   # row-preserving steps
                    out.append(op)
                    break
    return out


def test_single_partition_exchanges_only_take_aggregated_rows(spark):
    """A global window or total may only gather rows that an aggregate has
    already reduced (report grain, or one partial row per partition)."""
    writers = {"output_contract", "empty_fields", "tolerant_scan", "profile_json", "text_profile",
               "input_completeness", "csv_header_binding", "orders_summary_csv"}
    for key, fn in CATALOG.items():
        if "roundtrip" in key or key in writers:
            continue
        for child in _single_partition_inputs(_plan(fn(spark, SF_SMALL))):
            assert child in ("HashAggregate", "ObjectHashAggregate", "SortAggregate"), (key, child)


def _jobs(spark, build):
    """Jobs that run while a query is built."""
    spark.sparkContext.setJobGroup("build", "build")
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("build"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("key", ["enrich_products", "item_master", "order_status_report", "duplicate_rows", "dq_report"])
def test_building_a_query_runs_no_job(spark, key):
    assert _jobs(spark, lambda: CATALOG[key](spark, SF_SMALL)) == 0


def test_order_status_reads_only_what_it_needs(spark):
    plan = _plan(CATALOG["order_status_report"](spark, SF_SMALL))
    assert "customer.parquet" not in plan and "nation.parquet" not in plan
    assert plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin") <= 1
    assert plan.count("Exchange hashpartitioning") <= 3
    assert "l_extendedprice" not in plan


def test_output_contract_builds_the_master_once(spark, monkeypatch):
    """The second output starts from the first, published one, with the same rows."""
    from cartwright.sinks import writers as K

    real, given = K.write_with_contract, []
    monkeypatch.setattr(K, "write_with_contract", lambda df, *a, **k: (given.append(df), real(df, *a, **k))[1])
    rows = {r["dataset"]: r for r in CATALOG["output_contract"](spark, SF_SMALL).collect()}
    built, again = given
    assert "lineitem.parquet" in _plan(built) and "lineitem.parquet" not in _plan(again)
    assert again.dtypes == built.dtypes
    assert built.exceptAll(again).count() == again.exceptAll(built).count() == 0
    assert rows["master_orders"]["passed"] and rows["changed_orders"]["schema_match"]
    assert not rows["changed_orders"]["content_match"] and not rows["changed_orders"]["passed"]
    assert rows["master_orders"]["written_rows"] == rows["changed_orders"]["written_rows"] == built.count()
