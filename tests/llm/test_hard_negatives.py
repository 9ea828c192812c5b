"""Hard negatives against a plain search of every row."""

import math
import random

import numpy as np
import pytest
from helpers import collected
from pyspark.sql import functions as F

from cartwright.llm import hard_negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, score double, id string, shard int, block int"


def vectors(n, dims, seed, grid=None):
    """Rows around a few centres, so that windows fill; on a grid scores tie."""
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    out = []
    for i in range(n):
        c = centres[i % 4]
        x = [v + rnd.gauss(0, 0.6) for v in c]
        out.append((i, [round(v * grid) / grid if grid else v for v in x], rnd.randrange(3)))
    return out


def table(spark, rows):
    return spark.createDataFrame([(*r, 0.5, "x", 1, 2) for r in rows], SCHEMA)


def plain(rows, every, positives=5, negatives=3, low=50, high=95):
    """Every pair, with Python's integers."""
    ok = [(i, tuple(math.floor(256 * float(np.float32(x))) for x in v), l) for i, v, l in rows
          if l is not None and v is not None and all(x is not None and math.isfinite(x) and abs(x) < 2 ** 18 for x in v)]
    out, asked = [], set()
    by = lambda sc: lambda j: (-sc[j], ok[j][0] is None, ok[j][0] or 0)
    for a, (i, v, l) in enumerate(ok):
        if i is None or i % every or (i, v, l) in asked:
            continue
        asked.add((i, v, l))
        sc = [sum(x * y for x, y in zip(v, w)) for _, w, _ in ok]
        best = sorted((j for j in range(len(ok)) if j != a and ok[j][2] == l), key=by(sc))[:positives]
        others = sorted((j for j in range(len(ok)) if ok[j][2] != l), key=by(sc))
        for p in best:
            fit = [j for j in others if low * sc[p] <= 100 * sc[j] <= high * sc[p]][:negatives]
            out += [(i, ok[p][0], r + 1, ok[j][0], sc[p], sc[j]) for r, j in enumerate(fit)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard_values", [1 << 17, 1 << 8])
@pytest.mark.parametrize("grid", [None, 2])
def test_rows_equal_a_plain_search(spark, monkeypatch, shard_values, grid):
    """One shard, and several groups of shards whose results are merged."""
    monkeypatch.setattr(hard_negatives, "SHARD_VALUES", shard_values)
    monkeypatch.setattr(hard_negatives, "GROUP_VALUES", 2 * shard_values)
    rows = vectors(400, 6, 1, grid)
    got = collected(hard_negatives.mine(table(spark, rows), F.col("vec_id") % 20 == 0))
    assert got == plain(rows, 20) and len(got) > 100


def test_hard_cases(spark):
    rows = vectors(60, 4, 2, 2)
    rows += [rows[20], rows[20], rows[0], rows[40], (20, [1.0, 0.0, 0.0, 0.0], 1)]              # copies; an id twice
    rows += [(100, None, 1), (101, [1.0, None, 0.0, 0.0], 1), (102, [float("nan")] * 4, 1), (103, [1.0] * 4, None),
             (104, [float("inf"), 0.0, 0.0, 0.0], 2), (105, [1e6, 0.0, 0.0, 0.0], 2)]             # no part
    rows += [(None, [0.5, 0.5, 0.5, 0.5], 1), (None, [0.5, 0.5, 0.5, 0.5], 2), (120, [], 1), (140, [0.0] * 4, 2),
             (160, [-0.25, 0.1, 3.0], 0), (180, [-0.0, 2.0 ** 17, 1.0, -(2.0 ** 17)], 1)]         # ids, lengths, sizes
    padded = [(i, v if v is None else [*v, *[0.0] * (4 - len(v))], l) for i, v, l in rows]
    got = collected(hard_negatives.mine(table(spark, rows), F.col("vec_id") % 20 == 0))
    assert got == plain(padded, 20)


def test_empty_and_one_label(spark):
    assert collected(hard_negatives.mine(table(spark, []), F.col("vec_id") % 5 == 0)) == []
    rows = [(i, [1.0, 2.0], 1) for i in range(20)]
    assert collected(hard_negatives.mine(table(spark, rows), F.col("vec_id") % 5 == 0)) == []


def test_the_scan_stops_before_the_end():
    """With one direction far ahead, the threshold ends the scan early."""
    rnd = np.random.default_rng(3)
    matrix = rnd.integers(-20, 20, (5000, 8)).astype(np.int32)
    matrix[:10, 0] = 4000
    part = hard_negatives.Rows(np.arange(5000), np.zeros(5000, bool), np.zeros(5000, np.int64), np.ones(5000, np.int64), matrix)
    shard = hard_negatives.Rows(part.ids, part.no_id, part.labels, part.copies, matrix, part.sorted_lists())
    vector = np.array([100, 1, -1, 0, 0, 2, 0, 0], np.int64)
    best = hard_negatives.Best(5)
    seen = hard_negatives.search(shard, hard_negatives.exact_matrix(shard, 104.0), vector, [best],
                                 lambda at: shard.copies[at], lambda new: np.ones(len(new), bool))
    scores = matrix.astype(np.int64) @ vector
    assert seen < 1000
    assert best.listed() == [(int(i), int(scores[i])) for i in np.lexsort((np.arange(5000), -scores))[:5]]


def test_anchors_are_searched_together():
    """One scan feeds many anchors, each with windows, copies and labels of its own, as scans one by one do."""
    rnd = np.random.default_rng(5)
    matrix = rnd.integers(-3, 4, (700, 5)).astype(np.int32)
    matrix[0] = 0
    part = hard_negatives.Rows(rnd.permutation(700), rnd.random(700) < 0.05, rnd.integers(0, 3, 700), rnd.integers(1, 4, 700), matrix)
    shard = hard_negatives.Rows(part.ids, part.no_id, part.labels, part.copies, matrix, part.sorted_lists())
    exact = hard_negatives.exact_matrix(shard, 100.0)
    vectors = matrix[:60].astype(np.int64)
    low, high = np.full(60, -2), rnd.integers(-5, 20, 60)
    all_of = [hard_negatives.Best(5, anchors=60), hard_negatives.Best(3, low, high, 60)]
    hard_negatives.search(shard, exact, vectors, all_of, lambda at: shard.copies[at],
                          lambda new: shard.labels[new] != part.labels[:60, None])
    for k, best in enumerate(all_of):
        anchors, ids, no_id, scores = best.copied()
        for a in range(60):
            s = matrix.astype(np.int64) @ vectors[a]
            ok = (part.labels != part.labels[a]) & ((k == 0) | ((s >= -2) & (s <= high[a])))
            plain = sorted((-s[j], part.no_id[j], part.ids[j]) for j in np.flatnonzero(ok) for _ in range(part.copies[j]))
            here = anchors == a
            assert list(zip(-scores[here], no_id[here], ids[here])) == plain[:best.k]


def test_the_index_is_sent_once_for_few_anchors(spark, monkeypatch):
    """Tasks come from the groups of shards; the index is not dealt to a block for every core."""
    sent = []
    sequence = F.sequence
    monkeypatch.setattr(F, "sequence", lambda start, stop: (sent.append(stop._jc.toString()), sequence(start, stop))[1])
    rows = vectors(200, 4, 7)
    assert collected(hard_negatives.mine(table(spark, rows), F.col("vec_id") % 20 == 0)) == plain(rows, 20)
    assert sent[0] == "0"
