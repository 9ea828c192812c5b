import datetime as dt
import os
import tempfile
from decimal import Decimal

import pytest

from cartwright.plans.sql_runner import BrokenSql, run_sql_files, split_statements
from support import rows


def test_sql_files_run_against_views(spark):
    a = spark.createDataFrame(
        [("o1", "c1", "delivered", dt.datetime(2018, 1, 1), "SP", Decimal("10.00"), 3, True),
         ("o2", "c2", "delivered", dt.datetime(2018, 1, 2), "SP", Decimal("5.00"), None, False),
         ("o3", "c3", "canceled", dt.datetime(2018, 1, 2), "RJ", Decimal("0.00"), 1, False)],
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp timestamp_ntz, customer_state string, revenue decimal(28,2), "
        "delivery_days int, is_late boolean")
    d = tempfile.mkdtemp(prefix="cartwright-sql-")
    with open(os.path.join(d, "views.sql"), "w", encoding="utf-8") as fh:
        fh.write("CREATE OR REPLACE TEMP VIEW late_vw AS\nSELECT * FROM delivery_analysis_vw "
                 "WHERE is_late = TRUE;\n")
    with open(os.path.join(d, "01_status.sql"), "w", encoding="utf-8") as fh:
        fh.write("﻿SELECT order_status, COUNT(*) AS total_orders\nFROM analytics_orders\n"
                 "GROUP BY order_status\nORDER BY total_orders DESC;")
    with open(os.path.join(d, "02_late.sql"), "w", encoding="utf-8") as fh:
        fh.write("SELECT customer_state, COUNT(*) AS n FROM late_vw GROUP BY customer_state")
    out = run_sql_files(spark, a, d)
    assert set(out) == {"01_status", "02_late"}
    assert rows(out["01_status"]) == [("canceled", 1), ("delivered", 2)]
    assert rows(out["02_late"]) == [("SP", 1)]


def test_statements_are_split_outside_quotes_and_comments():
    text = ("-- a view; not a statement\n/* nor; /* this */ ; */\n"
            "CREATE OR REPLACE TEMP VIEW a AS SELECT ';' AS x, \"it''s;\" AS `y;``z`, 'don\\'t; ' AS d -- ;\n;;\n"
            " -- only a comment;\n;\nSET spark.x = 1;\n(SELECT 1) UNION SELECT 2;\nwith b AS (SELECT 3) SELECT * FROM b")
    found = split_statements(text)
    assert [(s.first_word, s.is_query) for s in found] == [
        ("create", False), ("set", False), ("(", True), ("with", True)]
    assert found[0].text.startswith("-- a view") and found[0].text.endswith("-- ;")
    assert found[3].text == "with b AS (SELECT 3) SELECT * FROM b"
    assert split_statements(" ;\n-- x\n; /* y */") == []
    for broken in ("SELECT 'a", "SELECT 1 /* x", "SELECT `a", "SELECT 1 /* a /* b */"):
        with pytest.raises(BrokenSql):
            split_statements(broken)


def test_files_with_comments_and_several_statements_run(spark):
    a = spark.createDataFrame(
        [("o1", "c1", "delivered", dt.datetime(2018, 1, 1), "S;P", Decimal("10.00"), 3, True),
         ("o2", "c2", "canceled", dt.datetime(2018, 1, 2), "RJ", Decimal("5.00"), None, False)],
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp timestamp_ntz, customer_state string, revenue decimal(28,2), "
        "delivery_days int, is_late boolean")
    d = tempfile.mkdtemp(prefix="cartwright sql-")
    files = {
        "zz_views.sql": "-- the late ones; by state\nCREATE OR REPLACE TEMP VIEW late_vw AS\n"
                        "SELECT * FROM analytics_orders WHERE is_late;\nCREATE OR REPLACE TEMP VIEW n_vw AS SELECT 7 AS n;",
        "01_late.sql": "/* report; */ SELECT customer_state, n FROM late_vw, n_vw WHERE customer_state = 'S;P';",
        "02_both.sql": "CREATE OR REPLACE TEMP VIEW n_vw AS SELECT 8 AS n;\nSELECT n FROM n_vw; SELECT count(*) AS c FROM late_vw",
        "03_none.sql": "-- nothing here\n", "notes.txt": "SELECT 1"}
    for name, text in files.items():
        with open(os.path.join(d, name), "w", encoding="utf-8") as fh:
            fh.write(text)
    for folder in (d, f"file://{d}"):
        out = run_sql_files(spark, a, folder)
        assert {k: rows(v) for k, v in out.items()} == {
            "01_late": [("S;P", 7)], "02_both_1": [(8,)], "02_both_2": [(1,)]}
    with pytest.raises(FileNotFoundError):
        run_sql_files(spark, a, f"{d}/none")
    with open(os.path.join(d, "04_broken.sql"), "w", encoding="utf-8") as fh:
        fh.write("SELECT 'x")
    with pytest.raises(BrokenSql, match="04_broken"):
        run_sql_files(spark, a, d)
