import os
import tempfile

import pytest
from pyspark.sql import types as T

from cartwright.session import scratch_path
from cartwright.sinks import writers as K
from cartwright.sources import readers as S

SCHEMA = T.StructType([
    T.StructField("product_category_name", T.StringType()),
    T.StructField("n", T.IntegerType()),
    T.StructField("ts", T.TimestampNTZType()),
])


def _write(text: str) -> str:
    d = tempfile.mkdtemp(prefix="cartwright-csv-")
    with open(os.path.join(d, "part.csv"), "w", encoding="utf-8") as fh:
        fh.write(text)
    return d


def test_tolerant_scan_bom_quotes_na_and_short_rows(spark):
    text = ("﻿product_category_name,n,ts\n"
            "\"beleza\nsaude\",1,2018-01-01 10:00:00\n"
            "\"say \"\"hi\"\"\",NA,not a time\n"
            "short\n"
            "x,abc,2018-01-02 00:00:00")
    scan = S.tolerant_scan(spark, "t", _write(text), SCHEMA, multiline=True)
    assert scan.status == "loaded"
    got = [tuple(r) for r in scan.frame.drop(S.CORRUPT).collect()]
    assert got[0][0] == "beleza\nsaude" and got[0][1] == 1      # quoted newline: one record
    assert got[1][0] == 'say "hi"' and got[1][1] is None and got[1][2] is None
    assert got[2] == ("short", None, None)
    assert got[3][1] is None                                      # non-numeric -> NULL
    assert len(got) == 4                                          # no trailing newline needed


def test_tolerant_scan_missing_path(spark):
    scan = S.tolerant_scan(spark, "reviews", "/nonexistent/cartwright/reviews.csv", SCHEMA)
    assert scan.status == "missing" and scan.frame is None


def test_typed_csv_roundtrip_and_contract(spark):
    df = spark.createDataFrame([("a", 1, None), ("b", None, None)], SCHEMA)
    path = scratch_path(spark, "t_csv")
    K.write_csv(df, path)
    back = S.read_csv_typed(spark, path, SCHEMA)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    c = K.write_with_contract(df, scratch_path(spark, "t_pq"), "t").collect()[0]
    assert c["expected_rows"] == c["written_rows"] == 2 and c["schema_match"] and c["success_marker"]
    assert c["passed"]


def _fails_at(k):
    from pyspark.sql import functions as F

    return F.when(F.col("id") == k, F.raise_error(F.lit("broken row")).cast("bigint")).otherwise(F.col("id"))


@pytest.mark.parametrize("write", ["write_parquet", "write_csv", "write_json"])
def test_a_failing_job_leaves_the_former_output(spark, tmp_path, write):
    path, read = str(tmp_path / "out"), {"write_parquet": spark.read.parquet, "write_json": spark.read.json,
                                         "write_csv": spark.read.option("header", True).csv}[write]
    getattr(K, write)(spark.range(5), path)
    with pytest.raises(Exception, match="broken row"):
        getattr(K, write)(spark.range(100, numPartitions=4).select(_fails_at(77).alias("id")), path)
    assert read(path).count() == 5
    getattr(K, write)(read(path).union(read(path)), path)       # a job may replace what it reads
    assert read(path).count() == 10
    assert sorted(os.listdir(tmp_path)) == ["out"]              # no staging, no former output left behind


def test_a_failing_bucketed_job_leaves_the_former_table(spark, tmp_path):
    path = str(tmp_path / "out")
    K.write_bucketed(spark.range(5), path, "t_staged", "id", 2)
    with pytest.raises(Exception, match="broken row"):
        K.write_bucketed(spark.range(100).select(_fails_at(77).alias("id")), path, "t_staged", "id", 2)
    assert spark.table("t_staged").count() == spark.read.parquet(path).count() == 5
    K.write_bucketed(spark.range(9), path, "t_staged", "id", 2)
    assert spark.table("t_staged").count() == 9
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("t_staged")] == ["t_staged"]
    spark.sql("DROP TABLE t_staged")


def test_a_failed_rename_puts_the_former_output_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    K.write_parquet(spark.range(5), path)
    real = K.rename

    def once_broken(spark, source, target):
        if "-staging-" in source:
            raise OSError("no rename")
        real(spark, source, target)

    monkeypatch.setattr(K, "rename", once_broken)
    with pytest.raises(OSError):
        K.write_parquet(spark.range(9), path)
    assert spark.read.parquet(path).count() == 5 and os.listdir(tmp_path) == ["out"]


def test_contract_compares_content(spark, tmp_path):
    from pyspark.sql import functions as F

    df = spark.range(50).select("id", (F.col("id") % 3).cast("int").alias("p"), F.array(F.lit(None), F.col("id")).alias("a"),
                                F.when(F.col("id") % 2 == 0, F.lit("x")).alias("s"),
                                F.create_map(F.lit("k"), F.col("id")).alias("m"))
    path = str(tmp_path / "out")
    assert K.write_with_contract(df, path, "t", ("p",)).first()["passed"]
    changes = {
        "one value": lambda d: d.withColumn("s", F.when(F.col("id") == 7, F.lit("y")).otherwise(F.col("s"))),
        "values between rows": lambda d: d.withColumn("s", F.when(F.col("id") % 2 == 1, F.lit("x"))),
        "a row twice for another": lambda d: d.where("id <> 7").union(d.where("id = 9")),
        "inside an array": lambda d: d.withColumn("a", F.reverse("a")),
        "a row less": lambda d: d.where("id <> 7"),
    }
    for what, change in changes.items():
        broken = K.write_with_contract(df, path, "t", write=lambda d, to, c=change: c(d).write.parquet(to))
        row = broken.first()
        assert not row["passed"] and not row["content_match"], what
        assert (row["written_rows"] == 50) == (what != "a row less") and row["schema_match"]
        with pytest.raises(K.ContractBroken, match="content match False"):
            K.assert_contract(broken)
        assert "p=0" in os.listdir(path)                         # the former output is still there
    assert K.write_with_contract(df.limit(0), path, "t").first()["passed"]


def test_scratch_paths_are_fresh_and_under_checkpoint_dir(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert a.startswith(root.rstrip("/"))


def test_partitioned_write_is_rebalanced(spark):
    from pyspark.sql import functions as F

    df = spark.range(0, 20000, numPartitions=8).select(
        (F.col("id") % 5).alias("month"), F.col("id"))
    path = scratch_path(spark, "t_parts")
    K.write_parquet(df, path, ("month",))
    local = path[len("file:"):] if path.startswith("file:") else path
    dirs = [d for d in os.listdir(local) if d.startswith("month=")]
    assert len(dirs) == 5
    for d in dirs:
        files = [f for f in os.listdir(os.path.join(local, d)) if f.endswith(".parquet")]
        assert 1 <= len(files) <= 2, (d, files)       # not one file per input task
    assert spark.read.parquet(path).count() == 20000


class _FakeConf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _FakeContext:
    def __init__(self, master, ckpt=None):
        self.master, self._ckpt = master, ckpt

    def getCheckpointDir(self):
        return self._ckpt

    def setCheckpointDir(self, path):
        self._ckpt = path


class _FakeSession:
    def __init__(self, master, conf_dir=None):
        self.conf, self.sparkContext = _FakeConf(conf_dir), _FakeContext(master)


def test_cluster_session_never_falls_back_to_a_local_temp_folder():
    from cartwright.session import checkpoint_root

    with pytest.raises(RuntimeError):
        checkpoint_root(_FakeSession("yarn"))
    shared = _FakeSession("yarn", "hdfs://nn/shared/ckpt/")
    assert checkpoint_root(shared) == "hdfs://nn/shared/ckpt"
    assert shared.sparkContext.getCheckpointDir() == "hdfs://nn/shared/ckpt/"
    with pytest.raises(RuntimeError):
        checkpoint_root(_FakeSession("local-cluster[2,1,1024]"))     # executors of their own
    local = _FakeSession("local[2]")
    assert checkpoint_root(local).startswith("/")             # temp folder, local mode only


def test_columns_are_bound_by_header(spark):
    path = _write("ts,extra,product_category_name\n2018-01-01 10:00:00,9,x\n")
    scan = S.tolerant_scan(spark, "t", path, SCHEMA)
    assert scan.header == ["ts", "extra", "product_category_name"]
    assert (scan.missing_columns, scan.extra_columns) == (["n"], ["extra"])
    r = scan.frame.first()
    assert (r["product_category_name"], r["n"], str(r["ts"])) == ("x", None, "2018-01-01 10:00:00")
    with pytest.raises(S.HeaderMismatch, match="n"):
        S.read_csv_typed(spark, path, SCHEMA)
    back = S.read_csv_typed(spark, path, T.StructType([SCHEMA["product_category_name"], SCHEMA["ts"]]))
    assert back.columns == ["product_category_name", "ts"] and back.first()[0] == "x"


def _write_files(files: dict[str, bytes]) -> str:
    d = tempfile.mkdtemp(prefix="cartwright csv-")
    for name, raw in files.items():
        with open(os.path.join(d, name), "wb") as fh:
            fh.write(raw)
    return d


def test_part_files_are_read_by_their_own_headers(spark):
    files = {"a.csv": b"product_category_name,n,ts\nx,1,2018-01-01 00:00:00\n",
             "b.csv": b"n,product_category_name,ts\n2,y,2018-01-01 00:00:00\n", "c.csv": b""}
    path = _write_files(files)
    assert sorted(r[:2] for r in map(tuple, S.read_csv_typed(spark, path, SCHEMA).collect())) == [("x", 1), ("y", 2)]
    with pytest.raises(S.HeaderMismatch, match="ts"):
        S.read_csv_typed(spark, _write_files({**files, "d.csv": b"n,product_category_name\n"}), SCHEMA)
    with pytest.raises(S.HeaderMismatch, match="more than once"):
        S.read_csv_typed(spark, _write_files({"d.csv": b"n,product_category_name,ts,n\n"}), SCHEMA)
    assert S.read_csv_typed(spark, _write_files({"c.csv": b""}), SCHEMA).collect() == []


def test_tolerant_scan_groups_files_by_header(spark):
    path = _write_files({
        "a.csv": b"\xef\xbb\xbfproduct_category_name,n,ts\r\nx,1,\r\n", "b.csv": b"ts,n,product_category_name\n,2,y\n",
        "c.csv": b"", "d.csv": b"\n \n", "e.csv": b"n,more\n3,z\n", "f.csv": b"n,product_category_name,n\n4,v,9\n",
        "g.csv": b"n,product_category_name\r5,w\r", "h.csv": b"\n\nn,product_category_name\n6,u\n"})
    scan = S.tolerant_scan(spark, "t", path, SCHEMA)
    assert scan.status == "loaded" and len(scan.heads.groups) == 5
    assert sorted((tuple(r)[:2] for r in scan.frame.collect()), key=lambda r: r[1]) == [
        ("x", 1), ("y", 2), (None, 3), ("v", 4), ("w", 5), ("u", 6)]
    assert (scan.missing_columns, scan.extra_columns) == ([], ["more"])
    assert scan.partial_columns == ["product_category_name", "ts"] and scan.duplicate_columns == ["n"]
    assert [os.path.basename(f.path) for f in scan.heads.empty] == ["c.csv", "d.csv"]


def test_whatever_is_wrong_with_one_table_leaves_the_others(spark):
    root = _write_files({"ok.csv": b"n\n1\n", "empty.csv": b"", "quote.csv": b'n,"ts\n1,2\n', "zip.csv.gz": b"no gzip",
                         "header.csv": b"n,ts"})
    names = {"ok": "ok.csv", "empty": "empty.csv", "quote": "quote.csv", "zip": "zip.csv.gz", "header": "header.csv",
             "none": "none.csv"}
    scans = S.tolerant_scans(spark, {k: f"{root}/{v}" for k, v in names.items()}, dict.fromkeys(names, SCHEMA))
    assert {k: s.status for k, s in scans.items()} == {
        "ok": "loaded", "empty": "empty", "quote": "unreadable", "zip": "unreadable", "header": "loaded", "none": "missing"}
    assert scans["ok"].frame.count() == 1 and scans["header"].frame.count() == 0
    assert all(s.message for k, s in scans.items() if s.frame is None)


def test_first_lines_and_their_bytes():
    from cartwright.sources.heads import FileHead, first_line

    assert first_line(b"a,b\n1,2\n", True) == (b"a,b", 4)
    assert first_line(b"\xef\xbb\xbfa,b\r\n1", True) == (b"a,b", 8)
    assert first_line(b"\r\n \na,b\r1", True) == (b"a,b", 8)
    assert first_line(b"a,b", True) == (b"a,b", 3)
    assert first_line(b"a,b", False) is None and first_line(b"\n\n", False) is None
    assert first_line(b"", True) == (None, 0) and first_line(b" \n", True) == (None, 2)
    assert FileHead("p", 9, b' a ,"b,c","d""e"').header() == ("a", "b,c", 'd"e')


def test_long_headers_are_fetched_whole(spark, monkeypatch):
    from cartwright.sources import heads

    monkeypatch.setattr(heads, "FIRST", 8)
    path = _write_files({"a.csv": b"\n" * 20 + b"n,product_category_name,ts\n1,x,\n"})
    (head,) = heads.file_heads(spark, path)
    assert head.header() == ("n", "product_category_name", "ts") and head.head_bytes == 47
    monkeypatch.setattr(heads, "LONGEST", 16)
    (head,) = heads.file_heads(spark, _write_files({"a.csv": b"n" * 500 + b"\n"}))
    assert "does not end" in head.error


def test_only_the_profiler_reads_words_as_null(spark):
    path = _write("product_category_name,n,ts\nNone,1,2018-01-01 00:00:00\n   ,2,\n,3,\n")
    names = lambda **how: [r[0] for r in S.tolerant_scan(spark, "t", path, SCHEMA, **how).frame.orderBy("n").collect()]
    assert names() == [None, None, None]
    assert names(null_tokens=()) == ["None", "   ", None]


def test_paths_are_probed_through_hadoop(spark):
    from cartwright.sources.fs import file_exists, path_exists

    d = _write("a\n1\n")
    for prefix in ("", "file:", "file://"):
        assert path_exists(spark, prefix + d) and file_exists(spark, f"{prefix}{d}/part.csv")
        assert not file_exists(spark, prefix + d) and not path_exists(spark, f"{prefix}{d}/none")
