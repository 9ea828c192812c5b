import pytest

from pyspark.sql import functions as F

from cartwright.operators import profile as P
from cartwright.operators import quality as Q
from support import rows


def test_column_stats_nulls_bytes_and_percentages(spark):
    df = spark.createDataFrame([("ab", 1), (None, 2), ("çé", None)], "s string, i int")
    got = rows(P.column_stats(df, "t"), "column_name", "null_count", "null_percentage", "logical_bytes")
    assert got == [("i", 1, 33.33, 8), ("s", 1, 33.33, 6)]


def test_duplicate_rows_treats_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "x"), (2, "y")], "a int, b string")
    assert P.duplicate_row_count(df).collect()[0][0] == 2
    assert P.duplicate_row_count(df.limit(0)).collect()[0][0] == 0
    swapped = spark.createDataFrame([(None, "x"), ("x", None)], "a string, b string")
    assert P.duplicate_row_count(swapped).collect()[0][0] == 0


def test_duplicate_rows_are_exact_when_hashes_collide(spark):
    df = spark.createDataFrame([(i, str(i % 3)) for i in range(20)] + [(3, "0"), (3, "0")], "a int, b string")
    for modulus in (1, 2, 7):
        got = P.duplicate_row_count(df, row_hash=lambda cols: F.col(cols[0]) % modulus).collect()[0][0]
        assert got == 2


def test_unique_rows_stay_in_their_scan(spark):
    """Full rows are exchanged only above the sketch's filter, which lets the
    repeated rows through and few others."""
    df = spark.range(20_000).select("id", F.col("id").cast("string").alias("text"))
    df = df.union(df.where("id % 100 = 0"))
    plan = P.duplicate_row_count(df)._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    assert "Join" not in plan
    wide = [k for k, line in enumerate(plan.splitlines()) if "Exchange hashpartitioning(id" in line]
    assert len(wide) == 1
    below = plan.splitlines()[wide[0]:]
    assert any("Filter (getbit" in line or "Filter (bit_get" in line or "Filter" in line and "scalar-subquery" in line
               for line in below)
    words = P._sketch_of(P._repeated(df.select(P._row_hash(df.columns).alias("_hash"))))
    passed = df.where(P._in_sketch(P._row_hash(df.columns), words))
    assert 400 <= passed.count() <= 400 + 20_000 * 2 / P.SKETCH_PER_HASH
    assert P.duplicate_row_count(df).first()[0] == 200


@pytest.mark.parametrize("most", [1 << 26, 1 << 10])
def test_a_full_sketch_changes_no_result(spark, monkeypatch, most):
    monkeypatch.setattr(P, "SKETCH_MOST", most)
    df = spark.range(3000).select((F.col("id") % 1500).alias("a"), F.when(F.col("id") % 3 > 0, F.lit("x")).alias("b"))
    expected = df.count() - df.distinct().count()
    assert P.duplicate_row_count(df).first()[0] == expected == 1500


def test_a_profile_reads_its_table_once(spark, tmp_path):
    """No scan of the table is left in the profile's plan, unless rows repeat."""
    df = spark.range(500).select("id", F.when(F.col("id") % 5 > 0, F.lit("x")).alias("s"))
    once = P.scan_once(df.withColumn("_bad", F.when(F.col("id") < 7, F.lit("line"))), True, "_bad")
    assert (once.corrupt_rows, once.repeats, once.hashes.count()) == (7, False, 500)
    path = str(tmp_path / "t")
    df.write.parquet(path)
    profile = P.profile_table(spark.read.parquet(path), "t", columns=True)
    assert path not in profile._jdf.queryExecution().executedPlan().toString()
    r = profile.first()
    assert (r["row_count"], r["null_cells"], r["duplicate_rows"], r["null_counts"]) == (500, 100, 0, {"id": 0, "s": 100})
    twice = P.profile_table(df.union(df.where("id < 3")), "t").first()
    assert (twice["row_count"], twice["duplicate_rows"]) == (503, 3)
    assert P.profile_table(df.limit(0), "t", columns=True).first()["inferred_types"] == {"id": "void", "s": "void"}


def test_inferred_types_follow_the_values(spark):
    df = spark.createDataFrame([("1", "1.5", "2018-01-02", "true", "x", None), ("-7", "2", "2018-01-02 03:04:05", "FALSE", "1", None)],
                               "a string, b string, c string, d string, e string, f string")
    got = {r["column_name"]: (r["data_type"], r["inferred_type"]) for r in P.column_stats(df, "t").collect()}
    assert got == {"a": ("string", "bigint"), "b": ("string", "double"), "c": ("string", "timestamp"),
                   "d": ("string", "boolean"), "e": ("string", "string"), "f": ("string", "void")}
    p = P.profile_table(df, "t", columns=True).collect()[0]
    assert p["inferred_types"]["b"] == "double" and p["null_counts"] == {**dict.fromkeys("abcde", 0), "f": 2}


def test_profile_table_schema_diff(spark):
    df = spark.createDataFrame([(1, "x")], "order_id int, extra string")
    r = P.profile_table(df, "orders", ["order_id", "order_status"]).collect()[0]
    assert r["schema_valid"] is False
    assert r["missing_columns"] == ["order_status"] and r["extra_columns"] == ["extra"]
    assert (r["row_count"], r["column_count"], r["duplicate_rows"]) == (1, 2, 0)


def test_dq_report_rules_and_gate(spark):
    good = spark.createDataFrame([("a", "x"), ("b", "y"), ("b", "y")], "order_id string, order_status string")
    rep = {r["rule"]: r for r in Q.dq_report(good).collect()}
    assert rep["non_empty"]["observed"] == 3 and rep["null_keys"]["passed"]
    assert rep["duplicate_keys"]["observed"] == 1 and rep["duplicate_keys"]["severity"] == "info"
    Q.assert_passed(Q.dq_report(good))
    bad = spark.createDataFrame([(None, "x")], "order_id string, other string")
    rep = {r["rule"]: r for r in Q.dq_report(bad).collect()}
    assert rep["required_columns"]["observed"] == 1 and not rep["required_columns"]["passed"]
    assert rep["null_keys"]["observed"] == 1
    with pytest.raises(RuntimeError):
        Q.assert_passed(Q.dq_report(bad))
    empty = spark.createDataFrame([], "order_id string, order_status string")
    with pytest.raises(RuntimeError):
        Q.assert_passed(Q.dq_report(empty))


def test_required_columns_must_hold_values(spark):
    hollow = spark.createDataFrame([(1, None), (2, None)], "order_id int, order_status string")
    got = Q.dq_report(hollow, rules=["required_columns", "filled_columns"]).collect()
    assert [(r["rule"], r["observed"], r["passed"]) for r in got] == [
        ("required_columns", 0, True), ("filled_columns", 1, False)]
