import os
import tempfile

import pytest

from cartwright.plans import pipeline as PL
from cartwright.plans.analytics import analytics_orders, master_from_tables
from cartwright.plans.reports import REPORTS
from cartwright.sinks import writers as K
from cartwright.sinks.writers import write_csv
from cartwright.sources import readers as S
from cartwright.sources.adapters import load_commerce
from support import SF_SMALL


def _raw_drop(spark, tables) -> str:
    raw = tempfile.mkdtemp(prefix="cartwright-raw-")
    for name, df in tables.as_dict().items():
        tmp = f"{raw}/_{name}"
        write_csv(df, tmp, single_file=True)
        part = [f for f in os.listdir(tmp) if f.startswith("part-")][0]
        os.rename(f"{tmp}/{part}", f"{raw}/{name}.csv")
    return raw


def test_raw_csv_pipeline_matches_parquet_route(spark):
    tables = load_commerce(spark, SF_SMALL)
    raw = _raw_drop(spark, tables)
    out = tempfile.mkdtemp(prefix="cartwright-out-")
    inputs = PL.open_inputs(spark, raw_dir=raw)
    status = inputs.statuses()
    assert status["reviews"] == "missing" and status["orders"] == "loaded"

    prof = {r["table_name"]: r for r in PL.profile_job(inputs, f"{out}/profile").collect()}
    assert prof["orders"]["schema_valid"] and prof["orders"]["row_count"] > 0
    assert prof["reviews"]["status"] == "missing" and prof["orders"]["corrupt_rows"] == 0
    assert prof["orders"]["inferred_types"]["order_purchase_timestamp"] == "timestamp"

    res = PL.transform_job(inputs, out, ("purchase_year", "purchase_month"))
    assert res.master_rows == res.source_rows["orders"]
    assert set(res.source_rows) == {"orders", "order_items", "customers", "products", "payments"}
    PL.quality_job(spark, res.master_path)

    paths = PL.reports_job(spark, res.master_path, f"{out}/reports")
    direct = analytics_orders(master_from_tables(tables))
    for name, fn in REPORTS.items():
        typed = S.read_csv_typed(spark, paths[name], fn(direct).schema)
        assert sorted(map(tuple, typed.collect()), key=repr) == sorted(map(tuple, fn(direct).collect()), key=repr), name


def test_bucketed_master_makes_report_dedup_shuffle_free(spark):
    from pyspark.sql import functions as F

    tables = load_commerce(spark, SF_SMALL)
    out = tempfile.mkdtemp(prefix="cartwright-bucketed-")
    res = PL.transform_job(tables, out, buckets=4)
    assert res.master_rows == res.source_rows["orders"]
    spark.catalog.dropTempView("analytics_orders")
    spark.sql("DROP TABLE IF EXISTS master_orders")   # a new session would not know it
    master = PL.read_master(spark, res.master_path, buckets=4)
    analytics = analytics_orders(master)
    plan = analytics._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(order_id" not in plan
    assert "Bucketed: true" in plan or "SelectedBucketsCount" in plan
    direct = analytics_orders(master_from_tables(tables))
    assert sorted(map(tuple, analytics.collect()), key=repr) == sorted(map(tuple, direct.collect()), key=repr)
    spark.sql("DROP TABLE IF EXISTS master_orders")


@pytest.mark.parametrize("buckets", [None, 3])
def test_a_truncated_output_makes_the_transform_raise(spark, monkeypatch, buckets):
    tables, out = load_commerce(spark, SF_SMALL), tempfile.mkdtemp(prefix="cartwright-broken-")
    for name in ("_parquet", "write_bucketed"):
        whole = getattr(K, name)
        monkeypatch.setattr(K, name, lambda df, *a, w=whole: (df.count(), w(df.limit(3), *a)))
    with pytest.raises(K.ContractBroken):
        PL.transform_job(tables, out, buckets=buckets)
    spark.sql("DROP TABLE IF EXISTS master_orders")


def test_a_table_that_breaks_while_it_is_read_leaves_the_others(spark):
    import gzip

    raw = tempfile.mkdtemp(prefix="cartwright-raw-")
    lines = "\n".join(f"s{i},{i},city{i * 7919 % 10007},SP" for i in range(50_000))
    packed = gzip.compress(f"seller_id,seller_zip_code_prefix,seller_city,seller_state\n{lines}\n".encode())
    with open(f"{raw}/sellers.csv.gz", "wb") as fh:
        fh.write(packed[:len(packed) // 2])
    with open(f"{raw}/customers.csv", "w", encoding="utf-8") as fh:
        fh.write("customer_id,customer_state\nc1,SP\nc1,SP\n")
    open(f"{raw}/payments.csv", "w").close()
    inputs = PL.open_inputs(spark, raw_dir=raw, file_names={"sellers": "sellers.csv.gz"})
    assert inputs.statuses()["payments"] == "empty"
    prof = {r["table_name"]: r for r in PL.profile_job(inputs, f"{raw}/profile").collect()}
    assert prof["sellers"]["status"] == "unreadable" and prof["sellers"]["message"]
    assert prof["payments"]["status"] == "empty"
    assert (prof["customers"]["status"], prof["customers"]["duplicate_rows"]) == ("loaded", 1)


def test_schema_validity_comes_from_the_header(spark):
    raw = tempfile.mkdtemp(prefix="cartwright-raw-")
    with open(f"{raw}/people.csv", "w", encoding="utf-8") as fh:
        fh.write("customer_id,bogus\nc1,2\n")
    inputs = PL.open_inputs(spark, raw_dir=raw, file_names={"customers": "people.csv"})
    prof = {r["table_name"]: r for r in PL.profile_job(inputs, f"{raw}/profile").collect()}
    assert len(prof) == 9 and prof["orders"]["status"] == "missing"
    c = prof["customers"]
    assert not c["schema_valid"] and c["extra_columns"] == ["bogus"] and "customer_state" in c["missing_columns"]
    with pytest.raises(ValueError):
        PL.open_inputs(spark, raw_dir=raw, file_names={"nobody": "x.csv"})


def test_sql_job_writes_the_packaged_reports(spark):
    tables, out = load_commerce(spark, SF_SMALL), tempfile.mkdtemp(prefix="cartwright-sql-")
    res = PL.transform_job(tables, out)
    paths = PL.sql_job(spark, res.master_path, f"{out}/sql")
    assert set(paths) == {"status_revenue", "late_by_state"}
    got = spark.read.option("header", True).csv(paths["status_revenue"])
    assert sum(int(r["orders"]) for r in got.collect()) == res.master_rows
