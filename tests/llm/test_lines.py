from collections import defaultdict

import pytest
from helpers import HARD, prose, table

from cartwright.llm import line_dedup as L


def key(line):
    return line.strip("\x20\x09\x0a\x0b\x0c\x0d").translate({c: c + 32 for c in range(65, 91)})


def brute(rows, min_docs, keep_first, min_chars=1):
    docs, first = defaultdict(set), {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        for p, line in enumerate((t or "").split("\n")):
            docs[key(line)].add(i)
            first.setdefault(key(line), (i, p))
            first[key(line)] = min(first[key(line)], (i, p), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        gone = [len(key(x)) >= min_chars and len(docs[key(x)]) >= min_docs
                and not (keep_first and first[key(x)] == (i, p)) for p, x in enumerate(lines)]
        out.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return sorted(out, key=repr)


def got(spark, rows, **how):
    df = L.dedup_lines(table(spark, rows), **how)
    back = df.select("row.*")
    assert back.schema == table(spark, rows).schema
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, table(spark, rows).collect()), key=repr)
    return sorted(((r["row"]["doc_id"], r["n_lines"], r["n_dropped"], bytes(r["kept"]).decode()) for r in df.collect()), key=repr)


def corpus():
    rows = [(k, "\n".join([prose(k, 8), ["Common Line", " common line\t", "COMMON LINE"][k % 3], prose(k % 7, 5), "hot",
                           "twice" if k in (3, 4) else prose(1000 + k, 4), "hot"])) for k in range(60)]
    return rows + [(None, "hot\nÉ upper"), (None, "é upper\nhot"), (200, "É upper"), (201, ""), (202, None)]


@pytest.mark.parametrize("min_docs,keep_first", [(10, False), (2, False), (2, True), (3, True), (1, False)])
def test_matches_brute_force(spark, min_docs, keep_first):
    rows = corpus()
    assert got(spark, rows, min_docs=min_docs, keep_first=keep_first) == brute(rows, min_docs, keep_first)


def test_hard_cases(spark):
    rows = [r for r in HARD if r[0] not in (8, 15)]        # one row per id, as positions of equal ids coincide
    assert got(spark, rows, min_docs=2, keep_first=False) == brute(rows, 2, False)


def test_equal_ids_are_one_document(spark):
    rows = [(1, "a\nb"), (1, "a\nc"), (2, "b"), (1, "a\nb")]
    assert got(spark, rows, min_docs=2, keep_first=False) == brute(rows, 2, False)


def test_shortest_key(spark):
    rows = [(k, "ab\nabcdef\néé") for k in range(4)]
    assert got(spark, rows, min_docs=3, keep_first=False, min_chars=3) == brute(rows, 3, False, 3)


def test_a_hot_line_over_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(L, "parallelism", lambda _: 23)
    rows = corpus()
    for keep_first in (False, True):
        assert got(spark, rows, min_docs=9, keep_first=keep_first) == brute(rows, 9, keep_first)


def test_empty_table(spark):
    assert L.dedup_lines(table(spark, [])).collect() == []


def test_bitmap():
    import zlib

    import numpy as np

    bits = np.zeros(9, np.uint8)
    bits[[1, 8]] = 1
    packed = zlib.compress(np.packbits(bits, bitorder="little").tobytes())
    assert L.apply_bitmap(b"a\nb\nc\nd\ne\nf\ng\nh\ni\nj", packed) == (10, 2, b"a\nc\nd\ne\nf\ng\nh\nj")
    assert L.apply_bitmap(b"a\nb", None) == (2, 0, b"a\nb")


def test_ids_that_are_no_numbers(spark):
    rows = [("a", "x\nhot"), ("b", "hot\ny"), (None, "hot"), (None, "hot\nz"), ("a", "x\nhot"), ("", "hot")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    back = sorted(((r["row"]["doc_id"], r["n_lines"], r["n_dropped"], bytes(r["kept"]).decode())
                   for r in L.dedup_lines(df, 4, keep_first=False).collect()), key=repr)
    assert back == sorted([("a", 2, 1, "x"), ("a", 2, 1, "x"), ("b", 2, 1, "y"), (None, 1, 1, ""), (None, 2, 1, "z"), ("", 1, 1, "")],
                          key=repr)
