"""The corpus pipeline against a plain version on a small fixture."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import WORDS, prose
from test_near_duplicates import brute as brute_classes
from tokenizers import Tokenizer

import corpus_pipeline as CP
from cartwright.llm import quality_cnn as Q
from cartwright.llm import secrets as S

EXTRA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, id bigint, text_hash bigint, row string"


def junk(seed, n):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS).upper() + "!!" for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rows = []
    for k in range(160):
        text = junk(k, 30) if k % 5 == 0 else prose(k % 120, 40 + k % 7) + ("\nthe common closing line" if k % 3 == 0 else "")
        if k % 11 == 1:
            text += f'\npassword = "{hashlib.md5(str(k).encode()).hexdigest()}"'
        rows.append((k, text))
    rows += [(500, None), (501, ""), (502, prose(7, 44)), (502, prose(7, 44)), (503, prose(9, 900))]
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), 0.1, 4, 3, "r") for i, t in rows], EXTRA)
    docs.write.parquet(f"{path}/documents.parquet")
    labels = spark.createDataFrame([(k, int(k % 5 != 0), 0) for k in range(160)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(f"{path}/labels.parquet")
    return path, rows


def plain(spark, path, rows):
    net = Q.train(spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet"))
    rows = [(i, t) for i, t in rows if net.score(np.frombuffer((t or "").encode(), np.uint8)) >= Q.THRESHOLD]
    docs = defaultdict(set)

    def key(line):
        return line.strip("\x20\x09\x0a\x0b\x0c\x0d").translate({c: c + 32 for c in range(65, 91)})

    for i, t in rows:
        for line in (t or "").split("\n"):
            docs[key(line)].add(i)
    rows = [(i, "\n".join(x for x in (t or "").split("\n") if not key(x) or len(docs[key(x)]) < 10)) for i, t in rows]
    keep, first = brute_classes(rows), {}
    leaders = {c for _, c in keep}
    rows = [(i, t) for i, t in rows if i in leaders and first.setdefault(i, t) is t]
    rows = [(i, S.redact(t, S.scan_text(t)[1])) for i, t in rows]
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tok.encode_special_tokens = True
    return {i: tok.encode(t, add_special_tokens=False).ids + [2] for i, t in rows}


def test_run_equals_the_plain_version(spark, folder):
    path, rows = folder
    want = plain(spark, path, rows)
    pieces = defaultdict(list)
    for p in CP.run(spark, path).collect():
        pieces[p["doc_id"]].append((p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]))
    assert set(pieces) == set(want)
    assert 5 not in want and 1 in want
    for i, ids in want.items():
        packed = np.array(ids, "<u4").tobytes()
        assert sum(n for _, n, _, _ in pieces[i]) == len(ids) == pieces[i][0][3]
        for start, n, crc, _ in pieces[i]:
            assert crc == zlib.crc32(packed[4 * start:4 * (start + n)])


def test_stages_keep_the_columns_of_documents(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in CP.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns, name
        assert {r["row"] for r in out.collect()} == {"r"}
        for r in out.where("text is not null and n_chars is not null").collect():
            assert r["n_chars"] == len(r["text"])
        assert stage(spark, docs.limit(0), path).collect() == []


def test_one_row_of_each_class_stays(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = [r["doc_id"] for r in CP.near_duplicates(spark, docs, path).collect()]
    assert Counter(kept) == Counter({c for _, c in brute_classes(rows)})


def test_equal_ids_in_two_classes_keep_a_row_of_each(spark):
    rows = [(1, prose(1, 50)), (1, prose(2, 50)), (2, prose(1, 50)), (None, prose(3, 40)), (None, prose(3, 40)), (4, prose(2, 50))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = CP.near_duplicates(spark, docs, "").collect()
    assert sorted(((r[0], r[1]) for r in got), key=repr) == sorted({rows[0], rows[1], rows[3]}, key=repr)
