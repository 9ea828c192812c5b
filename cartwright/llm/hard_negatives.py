"""Hard-negative mining by Fagin's threshold algorithm.

Vectors are dealt to shards, and each shard keeps, per dimension, the list of
its rows sorted by that component.  An anchor reads the lists of its non-zero
dimensions in parallel: from the largest value down where its own component is
positive, from the smallest up where it is negative (sorted access).  Every
row that turns up in any list is scored in full (random access, an integer
inner product).  The sum of the anchor's components times the values last read
bounds the score of every row not seen yet; the scan stops once this threshold
falls strictly below the k-th best score of everything that is asked for, so
rows of equal score are all seen and ties go by id.  Many anchors read together:
what one of them reads is scored for all that have not stopped, as one product
of matrices, and each stops by its own threshold.

Two passes: the first finds an anchor's positives (best rows of its own label),
whose scores open windows for the second, which finds the best rows of other
labels within each window.  Anchors are searched in blocks against groups of
shards, thresholds carry over from shard to shard of a group, and the groups'
few results are merged exactly.  The index is sent once a block, so blocks are
large and the tasks come from the groups.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwright.llm.common import materialize

SHARD_VALUES = 1 << 17      # components in a shard
GROUP_VALUES = 1 << 22      # components that one task searches
BLOCK_VALUES = 1 << 20      # components of a block's anchors, at most on average
SCORES = 1 << 21            # scored together, about
FIRST_DEPTH = 64            # of the lists, before the first look at the threshold; then doubled
LIMIT = 1 << 26             # of a quantised component's size: with it scores fit in 64 bits

INDEX = "shard int, grp int, ids binary, no_id binary, labels binary, copies binary, matrix binary, lists binary"
BLOCKS = "block int, ids binary, no_id binary, labels binary, matrix binary"
INDEX_NAMES = ["ids", "no_id", "labels", "copies", "matrix", "lists"]
BLOCK_NAMES = ["ids", "no_id", "labels", "matrix"]
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
FOUND = "block int, anchor int, anchor_id bigint, low bigint, high bigint, id bigint, score bigint"


@dataclass(frozen=True)
class Rows:
    """Quantised vectors: equal rows (id, label, vector) stand once, with their number."""
    ids: np.ndarray
    no_id: np.ndarray
    labels: np.ndarray
    copies: np.ndarray
    matrix: np.ndarray      # rows x dimensions, int32
    lists: np.ndarray | None = None     # dimensions x rows: rows by descending component

    @staticmethod
    def from_table(table: pa.Table, dims: int) -> Rows:
        sizes = np.asarray(table.column("q").combine_chunks().value_lengths())
        flat = np.asarray(table.column("q").combine_chunks().flatten())
        matrix = np.zeros((len(sizes), dims), np.int32)
        matrix[np.arange(dims) < sizes[:, None]] = flat        # a vector's missing last components count as 0
        ids = table.column("id").combine_chunks()
        return Rows(np.asarray(ids.fill_null(0)), np.asarray(ids.is_null()), np.asarray(table.column("label")),
                    np.asarray(table.column("copies")), matrix)

    def sorted_lists(self) -> np.ndarray:
        return np.argsort(-self.matrix, axis=0, kind="stable").T.astype(np.int32)

    def packed(self, names: list[str]) -> dict[str, pa.Array]:
        return {n: pa.array([getattr(self, n).tobytes()], pa.binary()) for n in names}

    @staticmethod
    def unpack(table: pa.Table, row: int, dims: int) -> Rows:
        raw = {c: table.column(c)[row].as_py() for c in table.column_names}
        ids = np.frombuffer(raw["ids"], np.int64)
        return Rows(ids, np.frombuffer(raw["no_id"], bool), np.frombuffer(raw["labels"], np.int64),
                    np.frombuffer(raw["copies"], np.int64) if "copies" in raw else np.ones(len(ids), np.int64),
                    np.frombuffer(raw["matrix"], np.int32).reshape(len(ids), dims),
                    np.frombuffer(raw["lists"], np.int32).reshape(dims, len(ids)) if "lists" in raw else None)


class Best:
    """For each of some anchors the k best rows (score down, id up, NULL last)
    with a score from low to high."""

    def __init__(self, k: int, low: np.ndarray | None = None, high: np.ndarray | None = None, anchors: int = 1):
        self.k, self.high = k, high
        # anchors, ids, ids missing, scores, copies
        self.rows = [np.zeros(0, t) for t in (np.int64, np.int64, bool, np.int64, np.int64)]
        self.bound = np.full(anchors, LEAST) if low is None else low.copy()     # unseen rows matter down to this score

    def add(self, anchors: np.ndarray, scores: np.ndarray, shard: Rows, at: np.ndarray, copies: np.ndarray,
            fits: np.ndarray) -> None:
        """Scores, copies and fits are of anchors x rows."""
        fit = fits & (scores >= self.bound[anchors, None])
        if self.high is not None:
            fit &= scores <= self.high[anchors, None]
        many = np.flatnonzero(np.count_nonzero(fit, axis=1) > self.k)
        if len(many):       # each row that fits counts at least once
            some = np.where(fit[many], scores[many], LEAST)
            last = some.shape[1] - self.k
            fit[many] &= some >= np.partition(some, last, axis=1)[:, last, None]
        a, r = np.nonzero(fit)
        if not len(a):
            return
        new = (anchors[a], shard.ids[at[r]], shard.no_id[at[r]], scores[a, r], copies[a, r])
        anchor, ids, no_id, score, n = (np.concatenate(x) for x in zip(self.rows, new))
        order = np.lexsort((ids, no_id, -score, anchor))
        order = order[self._before(anchor[order], n[order]) < self.k]
        self.rows = [anchor, _, _, score, n] = [x[order] for x in (anchor, ids, no_id, score, n)]
        ends = np.flatnonzero(np.append(anchor[1:] != anchor[:-1], True))
        ends = ends[(self._before(anchor, n) + n)[ends] >= self.k]
        self.bound[anchor[ends]] = score[ends]

    @staticmethod
    def _before(anchor: np.ndarray, n: np.ndarray) -> np.ndarray:
        """How many rows of the same anchor stand before each."""
        before = np.cumsum(n) - n
        return before - before[np.searchsorted(anchor, anchor)]

    def copied(self) -> list[np.ndarray]:
        """(anchors, ids, ids missing, scores), copies one by one."""
        anchor, *_, n = self.rows
        times = np.minimum(n, self.k - self._before(anchor, n)) if len(n) else n
        return [np.repeat(x, times) for x in self.rows[:4]]

    def listed(self) -> list[tuple[int | None, int]]:
        """(id, score) of a single anchor, copies one by one."""
        return [(None if none else i, s) for _, i, none, s in zip(*(x.tolist() for x in self.copied()))]


def exact_matrix(shard: Rows, norm: float) -> np.ndarray:
    """The matrix in a type that holds exactly the scores of vectors whose
    components' sizes add up to at most ``norm``."""
    peak = float(np.abs(shard.matrix).max(initial=0))
    return shard.matrix.astype(np.float64 if peak * norm < 2.0 ** 53 else np.int64)


def threshold_scan(shard: Rows, vectors: np.ndarray):
    """Sorted access in rounds: (rows seen first in this round, for each anchor
    the threshold that no unseen row's score exceeds)."""
    n, dims = len(shard.ids), np.arange(vectors.shape[1])
    down, up = np.flatnonzero((vectors > 0).any(axis=0)), np.flatnonzero((vectors < 0).any(axis=0))
    if not len(down) and not len(up):
        yield np.arange(n), np.full(len(vectors), LEAST)
        return
    plus, minus = np.maximum(vectors, 0), np.minimum(vectors, 0)
    seen, depth = np.zeros(n, bool), 0
    while depth < n:
        to = min(n, max(FIRST_DEPTH, 2 * depth))
        here = np.zeros(n, bool)
        here[shard.lists[down, depth:to].ravel()] = True
        here[shard.lists[up, n - to:n - depth].ravel()] = True
        new = np.flatnonzero(here & ~seen)
        seen |= here
        if seen.all():
            yield new, np.full(len(vectors), LEAST)
            return
        yield new, (plus @ shard.matrix[shard.lists[:, to - 1], dims].astype(np.int64)
                    + minus @ shard.matrix[shard.lists[:, n - to], dims].astype(np.int64))
        depth = to


def search(shard: Rows, matrix: np.ndarray, vectors: np.ndarray, wanted: list[Best], copies, fits) -> int:
    """Feeds ``wanted`` of some anchors (one in a row) from one shard; the
    number of scores taken.  ``copies`` and ``fits`` of rows are the same for
    all anchors, or of anchors x rows."""
    vectors = np.atleast_2d(vectors)
    active, scored = np.arange(len(vectors)), 0
    for new, threshold in threshold_scan(shard, vectors):
        if len(new):
            scored += len(active) * len(new)
            scores = (vectors[active].astype(matrix.dtype) @ matrix[new].T).astype(np.int64)
            shape = (len(vectors), len(new))
            n = np.broadcast_to(copies(new), shape)[active]
            fit = np.broadcast_to(fits(new), shape)[active] & (n > 0)
            for best in wanted:
                best.add(active, scores, shard, new, n, fit)
        bound = np.minimum.reduce([b.bound for b in wanted])
        active = active[threshold[active] >= bound[active]]
        if not len(active):
            break
    return scored


def own_rows(shard: Rows, part: Rows, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) where the shard has the anchor itself."""
    order = np.argsort(shard.ids, kind="stable")
    first, stop = (np.searchsorted(shard.ids[order], part.ids, side) for side in ("left", "right"))
    n = stop - first
    a = np.repeat(np.arange(len(n)), n)
    r = order[np.repeat(stop - np.cumsum(n), n) + np.arange(n.sum())]
    same = (part.no_id[a] == shard.no_id[r]) & (part.labels[a] == shard.labels[r])
    a, r = a[same], r[same]
    for d in range(vectors.shape[1]):
        same = vectors[a, d] == shard.matrix[r, d]
        a, r = a[same], r[same]
    return a, r


def windows_of(scores: list[int], low: int, high: int) -> list[tuple[int, int, int]]:
    """(positive score, least, largest) of each distinct window that is not
    empty: low * positive <= 100 * negative <= high * positive."""
    found = [(p, -((-low * p) // 100), high * p // 100) for p in sorted(set(scores))]
    return [w for w in found if w[1] <= w[2]]


def _found_table(block: int, found: list[tuple[Rows, int, np.ndarray | None, Best]]) -> pa.Table:
    """What was found for parts of a block's anchors: (the part, the number of
    its first anchor, the least scores or positive scores of windows, best)."""
    cols: list[list] = [[] for _ in range(6)]
    for part, start, lows, best in found:
        anchor, ids, no_id, score = best.copied()
        low = pa.nulls(len(anchor), pa.int64()) if lows is None else pa.array(lows[anchor], pa.int64())
        for col, x in zip(cols, (pa.array(start + anchor, pa.int32()),
                                 pa.array(part.ids[anchor], pa.int64(), mask=part.no_id[anchor]), low,
                                 pa.nulls(len(anchor), pa.int64()), pa.array(ids, pa.int64(), mask=no_id),
                                 pa.array(score, pa.int64()))):
            col.append(x)
    kinds = [pa.int32(), *[pa.int64()] * 5]
    anchor, *rest = (pa.chunked_array(c, k) for c, k in zip(cols, kinds))
    return pa.table([pa.array(np.full(len(anchor), block), pa.int32()), anchor, *rest],
                    names=["block", "anchor", "anchor_id", "low", "high", "id", "score"])


def mine(rows: DataFrame, is_anchor, positives: int = 5, negatives: int = 3, low_percent: int = 50,
         high_percent: int = 95, id_col: str = "vec_id", vector_col: str = "embedding",
         label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for each row where the column ``is_anchor`` is true and
    each of its best ``positives`` rows of the same label, the best
    ``negatives`` rows of other labels whose score is from ``low_percent`` to
    ``high_percent`` of the positive's.

    A score is the inner product of components floor(256 * x).  Rows with a
    NULL label or vector, or a NULL or non-finite component, take no part, nor
    do rows with a component of 2^18 or more, whose scores would not fit in 64
    bits.  Ids and labels are whole numbers.  Equal scores go by the smaller
    id, NULL last.  Equal rows are one anchor, but each of them is a row that
    can be found (so a copy of the anchor is a positive of it); rows of equal
    id that differ are rows each.  Shorter vectors count as padded with zeros.
    Where no window is open or filled there is no row; an empty table gives an
    empty result; other columns are ignored.
    """
    spark = rows.sparkSession
    vector = F.col(f"`{vector_col}`")
    usable = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) >= float(LIMIT >> 8)))
    clean = rows.where(F.col(f"`{label_col}`").isNotNull() & vector.isNotNull() & usable).select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{label_col}`").cast("bigint").alias("label"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("int")).alias("q"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    distinct = materialize(clean.groupBy("id", "label", "q").agg(
        F.count("*").alias("copies"), F.max("asks").alias("asks")), "negatives-rows")
    size = distinct.agg(F.count("*").alias("n"), F.max(F.size("q")).alias("d"),
                        F.count_if("asks").alias("a")).first()
    dims = max(1, size["d"] or 1)
    shards = max(1, math.ceil(size["n"] * dims / SHARD_VALUES))
    blocks = max(1, math.ceil(size["a"] * dims / BLOCK_VALUES))
    per_group = max(1, min(GROUP_VALUES // SHARD_VALUES,
                           shards * blocks // (2 * spark.sparkContext.defaultParallelism)))
    together = max(1, SCORES // max(1, SHARD_VALUES // dims))

    def build_shard(table: pa.Table) -> pa.Table:
        part = Rows.from_table(table, dims)
        number = table.column("shard")[0].as_py()
        return pa.table({"shard": pa.array([number], pa.int32()), "grp": pa.array([number // per_group], pa.int32()),
                         **replace(part, lists=part.sorted_lists()).packed(INDEX_NAMES)})

    def build_block(table: pa.Table) -> pa.Table:
        return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int32()),
                         **Rows.from_table(table, dims).packed(BLOCK_NAMES)})

    key = F.xxhash64("id", "label", "q")
    index = materialize(distinct.withColumn("shard", F.pmod(key, F.lit(shards)).cast("int"))
                        .select("shard", "id", "label", "q", "copies").groupBy("shard")
                        .applyInArrow(build_shard, INDEX), "negatives-index")
    anchors = materialize(distinct.where("asks").withColumn("block", F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int"))
                          .select("block", "id", "label", "q", "copies").groupBy("block")
                          .applyInArrow(build_block, BLOCKS), "negatives-anchors")
    groups = math.ceil(shards / per_group)
    dealt = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def shards_of(table: pa.Table, norm: float):
        """The group's shards in order, with their matrices."""
        for k in np.argsort(np.asarray(table.column("shard"))).tolist():
            shard = Rows.unpack(table.select(INDEX_NAMES), k, dims)
            yield shard, exact_matrix(shard, norm)

    def parts_of(table: pa.Table) -> list[tuple[int, Rows, np.ndarray]]:
        """The block's anchors, some at a time: (number of the first, rows, vectors)."""
        whole = Rows.unpack(table.select(BLOCK_NAMES), 0, dims)
        return [(k, Rows(*(getattr(whole, f)[k:k + together] for f in ("ids", "no_id", "labels", "copies", "matrix"))),
                 whole.matrix[k:k + together].astype(np.int64)) for k in range(0, len(whole.ids), together)]

    def norm_of(parts) -> float:
        return float(max(np.abs(v).sum(axis=1).max() for _, _, v in parts))

    def find_positives(indexed: pa.Table, asked: pa.Table) -> pa.Table:
        if not asked.num_rows or not indexed.num_rows:
            return _found_table(0, [])
        parts = parts_of(asked)
        wanted = [Best(positives, anchors=len(v)) for _, _, v in parts]
        for shard, matrix in shards_of(indexed, norm_of(parts)):
            for (_, part, vectors), best in zip(parts, wanted):
                a, r = own_rows(shard, part, vectors)

                def copies(at, vectors=vectors, shard=shard, a=a, r=r):
                    """Without the anchor itself."""
                    n = shard.copies[at]
                    here = np.isin(r, at)
                    if here.any():
                        n = np.tile(n, (len(vectors), 1))
                        n[a[here], np.searchsorted(at, r[here])] -= 1
                    return n

                search(shard, matrix, vectors, [best], copies,
                       lambda new, part=part, shard=shard: part.labels[:, None] == shard.labels[new])
        return _found_table(asked.column("block")[0].as_py(),
                            [(part, k, None, best) for (k, part, _), best in zip(parts, wanted)])

    def find_negatives(indexed: pa.Table, asked: pa.Table) -> pa.Table:
        if not asked.num_rows or not indexed.num_rows:
            return _found_table(0, [])
        parts, wanted = parts_of(asked), []
        scores: dict[int, list[int]] = {}
        for x in asked.column("scores")[0].as_py():
            scores.setdefault(x["anchor"], []).append(x["score"])
        for k, part, vectors in parts:
            windows = [windows_of(scores.get(k + j, []), low_percent, high_percent) for j in range(len(vectors))]
            found = []
            for w in range(max(map(len, windows))):
                # an anchor without this window: no score is large enough
                p, low, high = (np.array([min(max(x, LEAST), MOST) for x in c], np.int64) for c in zip(
                    *(of[w] if w < len(of) else (0, MOST, MOST) for of in windows)))
                found.append((p, Best(negatives, low, high, len(vectors))))
            wanted.append(found)
        for shard, matrix in shards_of(indexed, norm_of(parts)):
            for (_, part, vectors), found in zip(parts, wanted):
                if found:
                    search(shard, matrix, vectors, [b for _, b in found], lambda at, shard=shard: shard.copies[at],
                           lambda new, part=part, shard=shard: part.labels[:, None] != shard.labels[new])
        return _found_table(asked.column("block")[0].as_py(),
                            [(part, k, p, best) for (k, part, _), found in zip(parts, wanted) for p, best in found])

    def searched(asked: DataFrame, fn) -> DataFrame:
        asking = asked.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        return dealt.groupBy("block", "grp").cogroup(asking.groupBy("block", "grp")).applyInArrow(fn, FOUND)

    def first(found: DataFrame, k: int, *keys: str) -> DataFrame:
        by = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("id"))
        return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)

    best = materialize(first(searched(anchors, find_positives), positives, "block", "anchor").select(
        "block", "anchor", "anchor_id", "id", "score"), "negatives-positives")
    asked = materialize(anchors.join(best.groupBy("block").agg(
        F.collect_list(F.struct("anchor", "score")).alias("scores")), "block"), "negatives-windows")
    found = first(searched(asked, find_negatives), negatives, "block", "anchor", "low").select(
        "block", "anchor", "rank", F.col("low").alias("score"), F.col("id").alias("negative_id"),
        F.col("score").alias("negative_score"))
    return best.join(found, ["block", "anchor", "score"]).select(
        "anchor_id", F.col("id").alias("positive_id"), "rank", "negative_id", F.col("score").alias("positive_score"),
        "negative_score")
