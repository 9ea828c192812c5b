from collections import Counter

import numpy as np
from helpers import HARD, prose, table

from cartwright.llm import dart_minhash as D
from cartwright.llm.license_templates import words_of


def shingles(text):
    w = words_of((text or "").encode())
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(a, b):
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def brute(rows):
    """Least id of each row's class, by comparing all pairs."""
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    s = [shingles(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] or "") == (rows[j][1] or "") or similarity(s[i], s[j]) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    ids = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            ids[find(i)] = min(k, ids.get(find(i), k))
    return Counter((k, ids.get(find(i))) for i, (k, _) in enumerate(rows))


def near(seed, n, edits):
    words = prose(seed, n).split()
    for e in range(edits):
        words[(e * 37) % len(words)] = f"edit{seed}x{e}"
    return " ".join(words)


def test_hard_cases_match_brute_force(spark):
    got = Counter(tuple(r) for r in D.near_duplicates(table(spark)).select("doc_id", "class_id").collect())
    assert got == brute(HARD)


def test_groups_of_near_copies_match_brute_force(spark):
    rows = [(100 * s + k, near(s, 200, (k * 3) % 11)) for s in range(6) for k in range(12)]
    rows += [(9000 + k, near(3, 200, 1)) for k in range(40)]          # a hot group of exact copies
    got = Counter(tuple(r) for r in D.near_duplicates(table(spark, rows)).select("doc_id", "class_id").collect())
    assert got == brute(rows)


def test_blocks_do_not_change_classes(spark, monkeypatch):
    rows = [(k, near(5, 300, k % 5)) for k in range(60)]
    want = brute(rows)
    monkeypatch.setattr(D, "BLOCK", 7)
    got = Counter(tuple(r) for r in D.near_duplicates(table(spark, rows)).select("doc_id", "class_id").collect())
    assert got == want


def test_empty_table(spark):
    assert D.near_duplicates(table(spark, [])).collect() == []


def test_coordinates_agree_with_weighted_similarity():
    texts = [near(1, 400, k) for k in (0, 4, 10, 30)] + [prose(1, 400) + " " + "again and again now " * 20]
    doc, cells = D.cells_of([t.encode() for t in texts])
    sig = D.signatures(doc, cells, len(texts))
    s = [shingles(t) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            assert abs((sig[i] == sig[j]).mean() - similarity(s[i], s[j])) < 0.2
    assert (sig != 0).all()


def test_a_signature_does_not_depend_on_the_batch():
    texts = [prose(k, 5 + 40 * k).encode() for k in range(8)]
    together = D.signatures(*D.cells_of(texts), len(texts))
    for k, t in enumerate(texts):
        assert (D.signatures(*D.cells_of([t]), 1)[0] == together[k]).all()


def test_word_hashes_do_not_depend_on_segments(monkeypatch):
    text = (prose(9, 3000) + " " + "y" * 5000 + " " + prose(8, 50)).encode() + b" "
    want = D.word_hashes(text)
    monkeypatch.setattr(D, "SEGMENT", 1000)
    got = D.word_hashes(text)
    assert all(np.array_equal(a, b) for a, b in zip(want, got))


def test_thresholds_below_the_bands_are_refused(spark):
    import pytest

    with pytest.raises(ValueError):
        D.near_duplicates(table(spark, []), threshold=0.6)
    assert D.least_agreeing(0.8) == 59 and D.least_agreeing(1.0) == D.COORDINATES
