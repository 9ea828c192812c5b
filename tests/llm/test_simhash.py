"""SimHash fingerprints bit by bit, links against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from helpers import HARD, collected, prose, table

from cartwright.llm import simhash


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def plain_components(values):
    """Least place of each value's component, over all pairs."""
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(values):
        for j in range(i):
            if (x ^ values[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def near_values(seed, n, clusters=6):
    """Values around a few centres and values far from all."""
    rnd = random.Random(seed)
    centres = [rnd.getrandbits(64) for _ in range(clusters)]
    out = {rnd.getrandbits(64) for _ in range(n // 4)} | set(centres)
    while len(out) < n:
        x = rnd.choice(centres)
        for _ in range(rnd.randrange(1, 9)):
            x ^= 1 << rnd.randrange(64)
        out.add(x)
    return sorted(out)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_every_near_pair_meets_in_a_list():
    """Three differing bits in any bytes leave three equal bytes in one half."""
    for gone in [(a, b, c) for a in range(8) for b in range(a, 8) for c in range(b, 8)]:
        assert any(not set(gone) & set(t) for t in simhash.TRIPLES)
        assert any(not set(gone) & set(t) for t in simhash.FIVES)


@pytest.mark.parametrize("longest", [4096, 8])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, longest):
    """Also where lists are split and searched by look-up."""
    monkeypatch.setattr(simhash, "LIST", longest)
    values = near_values(1, 500)
    links = simhash.links_between(spark.createDataFrame([(signed(v),) for v in values], "f bigint")).collect()
    at = {signed(v): i for i, v in enumerate(values)}
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        assert (values[at[a]] ^ values[at[b]]).bit_count() <= 3
        x, y = find(at[a]), find(at[b])
        root[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(values))] == plain_components(values)


def test_look_up_equals_comparison():
    """A dense list: 3,000 values that agree in five bytes."""
    rnd = random.Random(5)
    values = np.array(sorted({0x1122334455000000 | rnd.getrandbits(14) << 7 for _ in range(3000)}), np.uint64)
    for distance in (1, 3):
        labels = []
        for a, b in (simhash.linked(values, distance), simhash.linked_by_lookup(values, (3, 4, 5, 6, 7), distance)):
            assert (np.bitwise_count(values[a] ^ values[b]) <= distance).all()
            label = np.arange(len(values))
            for _ in range(200):
                low = np.minimum(label[a], label[b])
                np.minimum.at(label, a, low)
                np.minimum.at(label, b, low)
            labels.append(label)
        assert (labels[0] == labels[1]).all()


def test_rows_equal_the_plain_form(spark):
    rows = [*HARD, (20, prose(9, 900)), (21, prose(9, 899) + " x"), (22, prose(9, 898) + " y z"), (23, "A b\tC\x0bd"),
            (24, "a B c\n\nD"), (25, "two words"), (26, "Two  WORDS "), (27, "a b c d e")]
    got = collected(simhash.near_duplicates(table(spark, rows)))
    prints = [plain_print(t) for _, t in rows]
    root = plain_components(prints)
    least = {}
    for r, (i, _) in zip(root, rows):
        least[r] = min([x for x in (least.get(r), i) if x is not None], default=None)
    assert got == sorted(((i, format(f, "016x"), least[r]) for (i, _), f, r in zip(rows, prints, root)), key=repr)


def test_long_texts_are_hashed_in_segments(monkeypatch):
    text = (prose(4, 700) + "\n\t ") * 3
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "SEGMENT", 5)
    assert simhash.fingerprint(text.encode()) == whole == np.uint64(plain_print(text)).astype(np.int64)


def test_empty_table_other_ids_and_wide_distances(spark):
    assert simhash.near_duplicates(table(spark, [])).count() == 0
    text_ids = spark.createDataFrame([("b", "one two three"), ("a", "one two three"), (None, None)], "doc_id string, text string")
    assert [(r[0], r[2]) for r in collected(simhash.near_duplicates(text_ids))] == [("a", "a"), ("b", "a"), (None, None)]
    with pytest.raises(ValueError):
        simhash.near_duplicates(text_ids, distance=4)
