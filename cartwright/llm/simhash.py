"""SimHash near-duplicates over a byte-position inverted index.

A fingerprint of 64 bits is eight bytes at fixed positions.  Fingerprints that
differ in at most three bits differ in at most three bytes, so they share five
positional bytes or more: the guaranteed minimum of the count filter.  Five of
eight positions put three into one half of the fingerprint, so the inverted
index is kept over the three-byte postings of either half (eight lists for a
fingerprint), in which every such pair meets.  Within a list the positional
bytes that a pair shares are tallied, pairs that reach the minimum are kept,
and kept pairs are verified by their differing bits.

Lists longer than ``LIST`` are split further, by two more positional bytes
that a pair must share as well.  What is still too long after that has 40 of
64 bits in common; its members look up their neighbours, all values that
differ in at most three of the other 24 bits, so the work stays linear.  Lists
give the links that connect their members, not all pairs.
"""

from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import id_type, materialize, parallelism, utf8
from cartwright.llm.dart_minhash import components

SHINGLE, DISTANCE, SEED = 3, 3, 42
POSITIONS = 8
SHARED = POSITIONS - DISTANCE                                   # positional bytes that a pair shares at least
TRIPLES = [t for half in (range(4), range(4, 8)) for t in combinations(half, 3)]
FIVES = list(combinations(range(POSITIONS), 5))
LIST = 4096                                                     # members compared with each other
SEGMENT = 1 << 20                                               # bytes of a text hashed together
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def shingle_hashes(raw: bytes):
    """Arrays of the XXH64 values of all shingles, repeats included."""
    at, words = 0, []
    seen_any = False
    while at < len(raw):
        cut = SPACE.search(raw, at + SEGMENT)
        stop = cut.end() if cut else len(raw)
        words += raw[at:stop].translate(LOWER).split()
        at = stop
        if len(words) >= SHINGLE:
            joined = b" ".join(words)
            size = np.fromiter(map(len, words), np.int64, len(words))
            end = np.cumsum(size + 1) - 1
            start = (end - size)[:len(words) - SHINGLE + 1].tolist()
            digest = xxhash.xxh64_intdigest
            yield np.fromiter((digest(joined[s:e], SEED) for s, e in zip(start, end[SHINGLE - 1:].tolist())),
                              np.uint64, len(start))
            seen_any, words = True, words[1 - SHINGLE:]
    if words and not seen_any:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)


def fingerprint(raw: bytes) -> int:
    """64 bits, each set if it is set in over half of the shingles' hashes;
    0 without words."""
    count, total = np.zeros(64, np.int64), 0
    for h in shingle_hashes(raw):
        for k in range(0, len(h), 1 << 14):
            part = h[k:k + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
            count += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(h)
    return int(np.packbits(2 * count > total, bitorder="little").view("<i8")[0])


def _sketch(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([fingerprint(x.as_py()) for x in batch.column(1)], pa.int64())], names=["id", "f"])


def _position(k: int):
    return F.shiftrightunsigned(F.col("f"), 8 * k).bitwiseAND(F.lit(255).cast("bigint"))


def _list_key(number: int, positions: tuple[int, ...]):
    """The list's number above the bytes at the positions."""
    key = F.lit(number).cast("bigint")
    for k in positions:
        key = F.shiftleft(key, 8).bitwiseOR(_position(k))
    return key


def _lists(choices) -> object:
    return F.explode(F.array(*(_list_key(n, c) for n, c in enumerate(choices)))).alias("key")


def linked(values: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Links (places in ``values``) that connect all that pairs of at most
    ``distance`` differing bits connect: a row is linked once with each
    component that it reaches."""
    n = len(values)
    component, left, right = np.arange(n), [], []
    for i in range(n - 1):
        different = values[i + 1:] ^ values[i]
        tally = (different.view(np.uint8).reshape(-1, POSITIONS) == 0).sum(axis=1)
        kept = np.flatnonzero(tally >= POSITIONS - distance)
        kept = kept[np.bitwise_count(different[kept]) <= distance] + i + 1
        reached, first = np.unique(component[kept], return_index=True)
        new = reached != component[i]
        if new.any():
            left += [i] * int(new.sum())
            right += kept[first[new]].tolist()
            component[np.isin(component, reached)] = component[i]
    return np.array(left, np.int64), np.array(right, np.int64)


def _masks(bits: int, distance: int) -> np.ndarray:
    return np.array([sum(1 << b for b in some) for d in range(1, distance + 1)
                     for some in combinations(range(bits), d)], np.int64)


def linked_by_lookup(values: np.ndarray, shared: tuple[int, ...], distance: int = DISTANCE):
    """As ``linked``, for distinct values that agree in the bytes at the
    positions ``shared``: each value looks up its neighbours in a table of the
    24 other bits."""
    parts = values.view(np.uint8).reshape(-1, POSITIONS)
    rest = sum(parts[:, k].astype(np.int64) << (8 * n) for n, k in enumerate(sorted(set(range(POSITIONS)) - set(shared))))
    place = np.full(1 << 24, -1, np.int32)
    place[rest] = np.arange(len(rest), dtype=np.int32)
    root, left, right = np.arange(len(rest), dtype=np.int32), [], []
    for mask in _masks(24, distance):
        other = place[rest ^ mask]
        a = np.flatnonzero(other > np.arange(len(rest)))
        b = other[a]
        apart = root[a] != root[b]
        if apart.any():
            a, b = a[apart], b[apart]
            left.append(a)
            right.append(b.astype(np.int64))
            np.minimum.at(root, np.maximum(root[a], root[b]), np.minimum(root[a], root[b]))
            while (root != root[root]).any():
                root = root[root]
    none = np.zeros(0, np.int64)
    return np.concatenate(left or [none]), np.concatenate(right or [none])


def _compare(distance: int, choices=None):
    """Streams (key, f) sorted by key; links of each list.  With ``choices``
    the lists share five positions, and long ones are searched by look-up."""
    def links(key: int, values: np.ndarray):
        if choices and len(values) > LIST:
            a, b = linked_by_lookup(values, choices[key >> 40], distance)
        else:
            a, b = linked(values, distance)
        return values[a].view(np.int64), values[b].view(np.int64)

    def run(batches):
        key, parts = None, []

        def close():
            values = np.concatenate(parts)
            return links(key, values) if len(values) > 1 else (np.zeros(0, np.int64),) * 2

        for batch in batches:
            keys, values = np.asarray(batch.column(0)), np.asarray(batch.column(1)).view(np.uint64)
            if not len(keys):
                continue
            edge = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))
            found = []
            for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist()):
                if keys[lo] != key:
                    if parts:
                        found.append(close())
                    key, parts = int(keys[lo]), []
                parts.append(values[lo:hi])
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], names=["a", "b"])
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in close()], names=["a", "b"])
    return run


def links_between(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): links that connect all fingerprints of the column ``f``
    (distinct) that pairs of at most ``distance`` differing bits connect."""
    if not 0 <= distance <= DISTANCE:
        raise ValueError("the lists guarantee to find distances up to 3")
    parts = parallelism(prints.sparkSession)
    postings = prints.select("f", _lists(TRIPLES))
    sizes = postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    meet = materialize(postings.join(sizes, "key").select("key", "f", (F.col("n") > LIST).alias("long")), "simhash-lists")

    def compared(rows, choices=None):
        return rows.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(
            _compare(distance, choices), "a bigint, b bigint")

    split = meet.where("long").select("f").distinct().select("f", _lists(FIVES)).select("key", "f")
    return compared(meet.where("not long").select("key", "f")).union(compared(split, FIVES))


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, fingerprint, component_id): one row per row of ``docs``.

    Texts are lower-cased (A-Z), cut into words at ASCII white space and hashed
    by three-word shingles, repeats included; texts of one or two words are
    one shingle; NULL, empty and blank texts have fingerprint zero, linked like
    any other.  component_id is the least id among all rows that links of at
    most ``distance`` differing bits (0 to 3) reach; NULL if all of them are
    NULL.  Repeated rows and equal ids are fine; other columns are ignored; an
    empty table stays empty.
    """
    kind = id_type(docs, id_col)
    rows = materialize(docs.select(F.col(f"`{id_col}`").alias("id"), utf8(text_col).alias("utf8")).mapInArrow(
        _sketch, f"id {kind}, f bigint"), "simhash-rows")
    prints = materialize(rows.groupBy("f").agg(F.min("id").alias("id")), "simhash-prints")
    roots = components(links_between(prints.select("f"), distance))
    grouped = prints.join(roots, F.col("f") == F.col("node"), "left").select(
        "f", "id", F.coalesce("root", "f").alias("root"))
    least = grouped.groupBy("root").agg(F.min("id").alias("component_id"))
    # written, so that the join below has a shuffle of its own on either side and a hot fingerprint can be split
    member = materialize(grouped.join(least, "root").select("f", "component_id"), "simhash-components")
    return rows.join(member, "f").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")
