"""Line dedup by sorted hashes.

Lines become (hash, document, position) rows, range-partitioned by hash and
document, so a line that is in a third of all documents spreads over many
partitions, and sorted with document and position as secondary order.  Each
partition is streamed once: it knows first occurrences and counts documents
run by run while holding the lines of fewer than ``min_docs`` documents.  Only
the first and last run of a partition may go on in a neighbour; their partial
counts are summed afterwards.  The result is a compressed bitmap per document
and not text.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwright.llm.common import as_text, materialize, parallelism, utf8

SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"   # fixed value: what is stripped at a line's ends
_LINE_FIELDS = "h1 bigint, h2 bigint, doc bigint, txt bigint, pos int"


def line_key(line: bytes) -> bytes:
    """Stripped at both ends, A-Z lower-cased (bytes beyond ASCII stay)."""
    return line.strip(SPACE).lower()


def _doc(docs: DataFrame, id_col: str) -> Column:
    """Whole-number ids as they are, others by a 64-bit hash; NULL stays."""
    own = F.col(f"`{id_col}`")
    if isinstance(docs.schema[id_col].dataType, T.IntegralType):
        return own.cast("bigint")
    return F.when(own.isNotNull(), F.xxhash64(own.cast("string")))


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(_doc(docs, id_col).alias("doc"), utf8(text_col).alias("utf8")).withColumn("txt", F.xxhash64("utf8"))


def _lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                some = batch.slice(k, 256)
                digests, counts, where = [], [], []
                for raw in some.column(1):
                    keys = [line_key(x) for x in raw.as_py().split(b"\n")]
                    good = [i for i, x in enumerate(keys)
                            if len(x) >= min_chars and (min_chars <= 1 or len(as_text(x)) >= min_chars)]
                    digests += [xxhash.xxh3_128_digest(keys[i]) for i in good]
                    counts.append(len(good))
                    where += good
                h = np.frombuffer(b"".join(digests), dtype=">i8").astype(np.int64).reshape(-1, 2)
                row = np.repeat(np.arange(len(counts)), counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[:, 0]), pa.array(h[:, 1]), some.column(0).take(pa.array(row)),
                     some.column(2).take(pa.array(row)), pa.array(where, pa.int32())],
                    names=["h1", "h2", "doc", "txt", "pos"])

    return _identified(docs, id_col, text_col).select("doc", "utf8", "txt").mapInArrow(run, _LINE_FIELDS)


class _Run:
    """The run of one line in one partition's stream."""

    def __init__(self, key, part, first):
        self.key, self.part, self.is_first = key, part, first
        self.docs, self.last_doc, self.held, self.lead, self.over = 0, (), [], None, False


def _stream(min_docs: int, keep_first: bool):
    """Rows out: kind 'drop' (a line surely dropped), 'open' (a line whose run
    may go on elsewhere), 'sum' (a partial count of such a run)."""
    def run(batches):
        from pyspark import TaskContext

        part, cur = TaskContext.get().partitionId(), None
        out: list[tuple] = []

        def row(kind, r, line, docs=0):
            out.append((kind, *r.key, *(line or (None, None, None)), r.part, docs))

        def close(r, last):
            if r.is_first or last:
                row("sum", r, r.lead, r.docs)
                if r.lead and (r.over or not r.held):
                    row("open", r, r.lead)
                for line in r.held:
                    row("open", r, line)
            r.held = []

        for batch in batches:
            h1, h2, doc, txt, pos = (c.to_pylist() for c in batch.columns)
            for a, b, d, t, p in zip(h1, h2, doc, txt, pos):
                if cur is None or cur.key != (a, b):
                    first = cur is None
                    if cur is not None:
                        close(cur, False)
                    cur = _Run((a, b), part, first)
                if cur.last_doc != (d,):
                    cur.docs, cur.last_doc = cur.docs + 1, (d,)
                line = (d, t, p)
                if not cur.over and cur.docs >= min_docs:
                    cur.over = True
                    # what was held is dropped; a run's very first line only
                    # if it needs no first occurrence, which close() settles
                    for x in cur.held:
                        if not (keep_first and x == cur.lead):
                            row("drop", cur, x)
                    cur.held = []
                if cur.lead is None:
                    cur.lead = line
                    if not cur.over:
                        cur.held.append(line)
                    elif not keep_first:
                        row("drop", cur, line)
                elif cur.over:
                    row("drop", cur, line)
                else:
                    cur.held.append(line)
            if len(out) >= 8192:
                yield _batch(out)
                out.clear()
        if cur is not None:
            close(cur, True)
        if out:
            yield _batch(out)
    return run


def _batch(rows):
    kinds = [pa.string(), *[pa.int64()] * 4, pa.int32(), pa.int32(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)],
                                      names=["kind", "h1", "h2", "doc", "txt", "pos", "part", "docs"])


def dropped_lines(docs: DataFrame, min_docs: int = 2, keep_first: bool = True, min_chars: int = 1,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, txt, pos) of every dropped line; txt is a hash of the whole text
    and tells rows of equal id and different text apart."""
    spark = docs.sparkSession
    lines = _lines(docs, id_col, text_col, min_chars)
    ordered = lines.repartitionByRange(parallelism(spark), "h1", "h2", "doc").sortWithinPartitions(
        "h1", "h2", "doc", "pos")
    seen = materialize(ordered.mapInArrow(_stream(min_docs, keep_first),
                                          "kind string, h1 bigint, h2 bigint, doc bigint, txt bigint, pos int,"
                                          " part int, docs bigint"), "line-runs")
    # at most two runs a partition are open, each of fewer than min_docs lines' documents
    totals = seen.where("kind = 'sum'").groupBy("h1", "h2").agg(
        F.sum("docs").alias("total"), F.min(F.struct("doc", "pos")).alias("lead"))
    late = seen.where("kind = 'open'").join(totals, ["h1", "h2"]).where(F.col("total") >= min_docs)
    if keep_first:
        late = late.where(~(F.struct("doc", "pos").eqNullSafe(F.col("lead"))))
    where = ["doc", "txt", "pos"]
    return seen.where("kind = 'drop'").select(*where).unionByName(late.select(*where))


def keep_bitmaps(docs: DataFrame, min_docs: int = 2, keep_first: bool = True, min_chars: int = 1,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, txt, dropped): for each document that loses a line the zlib
    compressed bitmap of its lines, bit set = dropped, little bit order; the
    others keep all lines."""
    @F.pandas_udf("binary")
    def bitmap(positions):
        def one(p):
            bits = np.zeros(int(max(p)) + 1, dtype=np.uint8)
            bits[p] = 1
            return zlib.compress(np.packbits(bits, bitorder="little").tobytes())
        return positions.map(one)

    gone = dropped_lines(docs, min_docs, keep_first, min_chars, id_col, text_col)
    return gone.groupBy("doc", "txt").agg(F.collect_set("pos").alias("p")).select(
        "doc", "txt", bitmap("p").alias("dropped"))


def apply_bitmap(text: bytes, bitmap: bytes | None) -> tuple[int, int, bytes]:
    """Number of lines, of dropped lines, and the kept lines joined again."""
    if bitmap is None:
        return text.count(b"\n") + 1, 0, text
    lines = text.split(b"\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), bitorder="little")
    gone = set(np.flatnonzero(bits).tolist())
    return len(lines), len(gone), b"\n".join(x for i, x in enumerate(lines) if i not in gone)


def dedup_lines(docs: DataFrame, min_docs: int = 2, keep_first: bool = True, min_chars: int = 1,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, n_lines, n_dropped, kept): ``row`` is a struct of all columns of
    ``docs`` as they were, ``kept`` the UTF-8 of the remaining lines.  Lines
    whose key has at least ``min_chars`` characters and stands in at least
    ``min_docs`` documents are dropped, all of them or all but the first
    occurrence (least id, then position).

    Rows of equal id count as one document; NULL ids are one document too.
    Ids that are no whole numbers are told apart, and ordered, by a 64-bit hash.
    NULL and empty texts are one empty line, which has no key to drop.  An
    empty table stays empty.
    """
    marks = keep_bitmaps(docs, min_docs, keep_first, min_chars, id_col, text_col)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                       _doc(docs, id_col).alias("own"), utf8(text_col).alias("utf8"))
    joined = rows.join(marks, F.col("own").eqNullSafe(F.col("doc")) & (F.xxhash64("utf8") == F.col("txt")), "left")

    @F.pandas_udf("n_lines bigint, n_dropped bigint, kept binary")
    def split(text, bitmap):
        import pandas as pd

        done = [apply_bitmap(t, b) for t, b in zip(text, bitmap)]
        return pd.DataFrame(done, columns=["n_lines", "n_dropped", "kept"])

    return joined.select("row", split("utf8", "dropped").alias("s")).select("row", "s.*")
