"""Near-duplicate classes by DartMinHash.

A document is a weighted set: its five-word shingles, weighted by how often
they occur.  Every unit of an element's weight is a region over the rank axis
at which darts are thrown by hashing (a Poisson process that depends on the
element alone), so two documents see the same darts where their weights
overlap.  A document collects the darts up to a rank that gives about
``k ln k + 2 k`` of them, however many elements it has, and keeps the
earliest per coordinate: a signature whose coordinates agree with the
probability of the weighted Jaccard similarity.

Signatures are banded.  Documents that share a band are candidates, and
candidates are verified exactly on their weighted shingles.  Copies are
reduced to one representative by their text's hash first.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import id_type, materialize, utf8
from cartwright.llm.license_templates import FOLD

SHINGLE, THRESHOLD = 5, 0.8
ROWS, BANDS = 4, 24                 # a pair of similarity 0.8 shares no band once in 300,000 times
COORDINATES = ROWS * BANDS
DARTS = COORDINATES * (math.log(COORDINATES) + 2)
STEP_BYTES = 1 << 20                # texts sketched together
SEGMENT = 1 << 22                   # bytes of one text hashed at a time

U = np.uint64
_BASE = 0x9E3779B97F4A7C15          # odd, so it has an inverse modulo 2^64


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U(0xD1342543DE82EF95))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def powers(base):
        out = np.ones(n, np.uint64)
        out[1:] = U(base)
        return np.multiply.accumulate(out)
    return powers(_BASE), powers(pow(_BASE, -1, 1 << 64))


def word_hashes(folded: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of every word: a polynomial of its bytes, read
    off prefix sums, then mixed."""
    starts, hashes, at = [], [], 0
    while at < len(folded):
        stop = len(folded)
        if stop - at > SEGMENT:     # cut at white space
            stop = folded.rfind(b" ", at, at + SEGMENT) + 1 or folded.find(b" ", at + SEGMENT) + 1 or len(folded)
        data = np.frombuffer(folded, np.uint8, stop - at, at)
        size = 1 << max(16, (len(data) + 1).bit_length())
        power, inverse = _powers(size)
        inside = data != 32
        edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
        s, e = edge[::2], edge[1::2]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * power[:len(data)], out=sums[1:])
        hashes.append(mix((sums[e] - sums[s]) * inverse[s]))
        starts.append(s + at)
        at = stop
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(hashes)


def cells_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(document number, cell) for all texts, sorted by both: one cell per
    unit of a shingle's weight.  Texts of fewer than five words are one
    shingle of all their words; texts without words have no cells."""
    folded = [t.translate(FOLD) for t in texts]
    ends = np.cumsum([len(t) + 1 for t in folded])
    starts, w = word_hashes(b" ".join(folded) + b" ")
    doc = np.searchsorted(ends, starts, side="right")
    words = np.bincount(doc, minlength=len(texts))
    last = np.cumsum(words)
    grams, owner = [], []
    if len(w) >= SHINGLE:
        n = len(w) - SHINGLE + 1
        g = w[:n]
        for k in range(1, SHINGLE):
            g = mix(g * U(0xC2B2AE3D27D4EB4F) + w[k:k + n])
        whole = doc[:n] == doc[SHINGLE - 1:]
        grams.append(g[whole])
        owner.append(doc[:n][whole])
    short = np.flatnonzero((words > 0) & (words < SHINGLE))
    if len(short):
        g = np.zeros(len(short), np.uint64)
        for k, d in enumerate(short):
            for h in w[last[d] - words[d]:last[d]]:
                g[k:k + 1] = mix(g[k:k + 1] * U(0xC2B2AE3D27D4EB4F) + h + U(1))
        grams.append(g)
        owner.append(short)
    if not grams:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    g, d = np.concatenate(grams), np.concatenate(owner)
    order = np.lexsort((g, d))
    g, d = g[order], d[order]
    fresh = np.concatenate(([True], (g[1:] != g[:-1]) | (d[1:] != d[:-1])))
    nth = np.arange(len(g)) - np.maximum.accumulate(np.where(fresh, np.arange(len(g)), 0))
    cells = mix(g + nth.astype(np.uint64) * U(0xA24BAED4963EE407))
    order = np.lexsort((cells, d))
    return d[order], cells[order]


def signatures(doc: np.ndarray, cells: np.ndarray, n_docs: int) -> np.ndarray:
    """n_docs x COORDINATES hashes of the earliest dart per coordinate;
    documents without cells keep zeros."""
    sig = np.zeros((n_docs, COORDINATES), np.uint64)
    weight = np.bincount(doc, minlength=n_docs)
    todo, reach = weight > 0, DARTS
    while todo.any():
        pick = todo[doc]
        d, c = doc[pick], cells[pick]
        limit = reach / weight[d]
        rank, got, nth = np.zeros(len(d)), [], 0
        while len(d):
            throw = mix(c + U((2 * nth + 1) * _BASE & (1 << 64) - 1))
            rank = rank - np.log(((throw >> U(11)).astype(np.float64) + 0.5) / (1 << 53))
            near = rank <= limit
            d, c, rank, limit = d[near], c[near], rank[near], limit[near]
            got.append((d, rank, mix(throw[near] ^ U(_BASE))))
            nth += 1
        d, rank, dart = (np.concatenate(x) for x in zip(*got))
        slot = d * COORDINATES + (dart % U(COORDINATES)).astype(np.int64)
        late_first = np.argsort(-rank, kind="stable")
        seen = np.zeros(n_docs * COORDINATES, bool)
        seen[slot] = True
        sig.reshape(-1)[slot[late_first]] = dart[late_first]     # the earliest is written last
        todo &= ~seen.reshape(n_docs, -1).all(axis=1)            # a coordinate without a dart: look further
        reach *= 2
    return sig


def band_hashes(sig: np.ndarray) -> np.ndarray:
    parts = sig.reshape(len(sig), BANDS, ROWS)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * U(_BASE), parts.shape[:2]).copy()
    for k in range(ROWS):
        h = mix(h * U(0xC2B2AE3D27D4EB4F) + parts[:, :, k])
    return h.view(np.int64)


def _steps(texts: pa.Array):
    """Slices of about STEP_BYTES: (start, texts)."""
    start, some, size = 0, [], 0
    for k, x in enumerate(texts):
        some.append(x.as_py())
        size += len(some[-1])
        if size >= STEP_BYTES:
            yield start, some
            start, some, size = k + 1, [], 0
    if some:
        yield start, some


def _sketch(batches):
    for batch in batches:
        for start, texts in _steps(batch.column(2)):
            doc, cells = cells_of(texts)
            bands = band_hashes(signatures(doc, cells, len(texts)))
            filled = np.bincount(doc, minlength=len(texts)) > 0
            lists = pa.ListArray.from_arrays(
                np.concatenate(([0], np.cumsum(filled * BANDS))).astype(np.int32), bands[filled].reshape(-1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(start, len(texts)), batch.column(1).slice(start, len(texts)), lists],
                names=["id", "t", "bands"])


def _packed_cells(batches):
    """Cells in 32 bits, and the low byte of each coordinate for a quick estimate."""
    for batch in batches:
        for start, texts in _steps(batch.column(1)):
            doc, cells = cells_of(texts)
            sig = signatures(doc, cells, len(texts)).astype(np.uint8)
            at = np.searchsorted(doc, np.arange(len(texts) + 1))
            packed = [np.unique((cells[at[i]:at[i + 1]] >> U(32)).astype("<u4")).tobytes() for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(start, len(texts)), pa.array([x.tobytes() for x in sig], pa.binary()),
                 pa.array(packed, pa.binary())], names=["t", "low", "cells"])


def least_agreeing(threshold: float) -> int:
    """Agreeing coordinates below which a pair of the threshold's similarity
    falls once in 100,000 times: 4.5 standard deviations below the mean."""
    return int(COORDINATES * threshold - 4.5 * math.sqrt(COORDINATES * threshold * (1 - threshold)))


def linked_pairs(cells: list[np.ndarray], low: np.ndarray, side: np.ndarray | None, threshold: float):
    """Pairs of similarity at least the threshold that connect all that such
    pairs connect: pairs whose ends are connected already are not compared.
    With ``side``, only pairs between the two sides."""
    n, least = len(cells), least_agreeing(threshold)
    size = np.array([len(c) for c in cells])
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(n - 1):
        agree = (low[i + 1:] == low[i]).sum(axis=1)
        small, large = np.minimum(size[i + 1:], size[i]), np.maximum(size[i + 1:], size[i])
        fit = (agree >= least) & (small >= threshold * large)
        if side is not None:
            fit &= side[i + 1:] != side[i]
        for j in (np.flatnonzero(fit) + i + 1)[np.argsort(-agree[fit], kind="stable")]:
            a, b = find(i), find(int(j))
            if a != b:
                both = len(np.intersect1d(cells[i], cells[j], assume_unique=True))
                if both >= threshold * (size[i] + size[j] - both):
                    root[max(a, b)] = min(a, b)
                    yield i, int(j)


BLOCK = 512   # members of a bucket compared in one go


def _verify(threshold: float):
    """Streams (b, lo, hi, block, t, low, cells) sorted by the first three."""
    def links(rows):
        some = [r for r in rows]
        t = [r[4] for r in some]
        low = np.frombuffer(b"".join(r[5] for r in some), np.uint8).reshape(len(some), -1)
        cells = [np.frombuffer(r[6], "<u4") for r in some]
        side = np.array([r[3] for r in some]) if some[0][1] != some[0][2] else None
        return [(t[i], t[j]) for i, j in linked_pairs(cells, low, side, threshold)]

    def batch_of(found):
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()),
                                           pa.array([b for _, b in found], pa.int64())], names=["a", "b"])

    def run(batches):
        key, rows, found = None, [], []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:3] != key:
                    if len(rows) > 1:
                        found += links(rows)
                    key, rows = row[:3], []
                rows.append(row)
            yield batch_of(found)
            found = []
        if len(rows) > 1:
            yield batch_of(links(rows))
    return run


def components(links: DataFrame) -> DataFrame:
    """(node, root) of the connected components of links (a, b): root is a
    component's least node.  Alternating large-star and small-star steps, each
    a group-by and a join, written to the shared folder; hubs are joined back
    edge by edge and never gathered."""
    def stars(edges, large):
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        keep = both if large else both.where("b < a")
        least = keep.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        near = keep.where("b > a") if large else keep
        moved = near.join(least, "a").select(F.col("b").alias("x"), "m")
        if not large:
            moved = moved.union(least.select(F.col("a").alias("x"), "m"))
        return moved.where("x <> m").select(F.greatest("x", "m").alias("a"), F.least("x", "m").alias("b")).distinct()

    edges = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(
        "a <> b").distinct(), "links")
    before = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            break
        before = now
        edges = materialize(stars(stars(edges, True), False), "stars")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b"), F.col("b")).distinct())


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, class_id, class_size, class_key, text_key): one row per row of
    ``docs``; class_id is the least id among the rows that are connected by
    pairs of similarity >= threshold (0.8 or more), class_key a hash that tells classes apart
    where ids do not, text_key the hash of the row's text.

    Equal texts are always one class (texts are told apart by a 64-bit hash);
    NULL counts as the empty text.  Texts without words are in a class with
    equal texts only; texts of fewer than five words with texts of the same
    words.  Repeated rows and equal ids are fine; a class whose ids are all
    NULL has class_id NULL; other columns are ignored; an empty table stays
    empty.  Buckets of any size are compared in full, block by block.
    """
    if not THRESHOLD <= threshold <= 1:
        raise ValueError("the bands are laid out for similarities of 0.8 or more")
    spark = docs.sparkSession
    base = docs.select(F.col(f"`{id_col}`").alias("id"), utf8(text_col).alias("utf8")).withColumn("t", F.xxhash64("utf8"))
    kind = id_type(docs, id_col)
    rows = materialize(base.select("id", "t", "utf8").mapInArrow(
        _sketch, f"id {kind}, t bigint, bands array<bigint>"), "dart-sketches")
    texts = rows.groupBy("t").agg(F.min("id").alias("id"), F.first("bands").alias("bands"))
    banded = texts.select("t", "id", F.explode("bands").alias("b"))
    # buckets of the same members are compared once
    buckets = banded.groupBy("b").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("t")).alias("f"), F.min("t").alias("m")).where("n > 1")
    once = buckets.groupBy("n", "f", "m").agg(F.min("b").alias("b")).select("b", "n")
    members = materialize(banded.join(once, "b"), "dart-buckets")
    involved = members.select("t", "id").distinct()
    # the involved texts grow with the corpus, so the plan shuffles them at every size
    found = base.join(involved.withColumnRenamed("t", "t2").withColumnRenamed("id", "id2").hint("merge"),
                      (F.col("t") == F.col("t2")) & F.col("id").eqNullSafe(F.col("id2")), "left_semi")
    cells = materialize(found.select("t", "utf8").mapInArrow(
        _packed_cells, "t bigint, low binary, cells binary"), "dart-cells").dropDuplicates(["t"])
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = members.withColumn("block", F.pmod(F.xxhash64("t", "b"), parts).cast("int")).select(
        "b", "t", "block", F.explode(F.sequence(F.lit(0), parts - 1)).alias("other")).select(
        "b", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "t")
    links = dealt.join(cells, "t").select("b", "lo", "hi", "block", "t", "low", "cells").repartition(
        int(spark.conf.get("spark.sql.shuffle.partitions")), "b", "lo", "hi").sortWithinPartitions(
        "b", "lo", "hi").mapInArrow(_verify(threshold), "a bigint, b bigint")
    roots = components(links)
    grouped = rows.select("id", "t").join(roots, F.col("t") == F.col("node"), "left").select(
        "id", F.coalesce("root", "t").alias("g"), "t")
    # written, so that the join below has a shuffle of its own on either side and a hot class can be split
    first = materialize(grouped.groupBy("g").agg(F.min("id").alias("class_id"), F.count("*").alias("class_size")),
                        "dart-classes")
    return grouped.join(first, "g").select(
        F.col("id").alias(id_col), "class_id", "class_size", F.col("g").alias("class_key"), F.col("t").alias("text_key"))
