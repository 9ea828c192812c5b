"""Cross-tokenizer alignment: divide and conquer at shared cuts.

Two tokenizers cut the same bytes at different offsets.  Where a token of A
and one of B end together is a shared cut.  An interval between two cuts is
divided at a shared cut near its middle, found by bisection: the first end of
A from the middle on is looked up among B's ends, the end of B found there
among A's, and so on in turns until both agree, then the same to the left.
Both halves are treated alike; an interval without a cut inside is a leaf, a
group of tokens of A and of B that cover the same bytes.  All intervals of a
level, over all texts of a chunk, are divided together.

Counts of linked id pairs are taken over the whole corpus: a chunk sends its
distinct pairs with their numbers, not its links, and gets the corpus's counts
of just these pairs back.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import ARROW, as_text, id_type, materialize, utf8

CHUNK_BYTES = 1 << 19       # of texts aligned together
MEMO_WORDS, MEMO_LENGTH = 250_000, 64   # words whose ids a worker remembers, and their longest
LEARNED = 64                # words tokenised in one text
LEAPS = 16                  # looks in turn, before all ends of an interval's half are looked up at once
HASHED = 1 << 16            # ids written out together
CUT = re.compile(r"(?<=\S) (?=\S)")                     # neither tokenizer joins across such a space
WHITE = [c for c in map(chr, range(0x3001)) if c.isspace()]


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the
    others as the characters from 256 on."""
    own = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(others)}


class Pair:
    """Both tokenizers, the bytes of their ids and these bytes' numbers."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark's tasks are the parallelism
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True              # their strings are plain text
        byte_of, words = _byte_of(), self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(words.values()) + 1)
        for word, i in words.items():
            self.bytes_a[i] = bytes(map(byte_of.__getitem__, word))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.size_a = np.array(list(map(len, self.bytes_a)), np.int64)
        self.size_b = np.array(list(map(len, self.bytes_b)), np.int64)
        self.apart = not any("▁" in p.lstrip("▁") for p in pieces)
        ids = range(max(len(self.bytes_a), len(self.bytes_b)))
        self.written = [b"%d%s" % (i, sep) for sep in (b",", b"|", b";") for i in ids]
        self.written_step = len(ids)
        self.ids_a: dict[str, bytes] = {}
        self.ids_b: dict[str, bytes] = {}
        self.odd: set[str] = set()      # words whose tokens' bytes are not space + word

    def words(self, text: str) -> list[str]:
        """The text between the single spaces that stand between other
        characters.  A's split takes such a space to what follows, and no piece
        of B has a space after another character, so each word is tokenised by
        itself as it is in the text.  (One word, where B has such pieces.)"""
        if not self.apart:
            return [text]
        single = not (text.startswith(" ") or text.endswith(" ") or any(
            c in text and (c + " " in text or " " + c in text) for c in WHITE))
        return text.split(" ") if single else CUT.split(text)

    def _same(self, raw: bytes, a: list[int], b: list[int]) -> bool:
        whole = b" " + raw
        return (b"".join(map(self.bytes_a.__getitem__, a)) == whole
                and b"".join(map(self.bytes_b.__getitem__, b)) == whole)

    def _encode(self, texts: list[str]):
        by_a = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return zip(texts, (e.ids for e in by_a), self.b.encode(texts, num_threads=1))

    def _learn(self, words: list[str]) -> None:
        """Tokenises words, many in one text where no space of their own
        stands at their ends; tokens end where the words end."""
        alone = [w for w in words if w != w.strip() or not w]
        inner = [w for w in words if w == w.strip() and w]
        groups = [inner[k:k + LEARNED] for k in range(0, len(inner), LEARNED)]
        for some, (text, a, b) in zip(groups, self._encode([" ".join(g) for g in groups])):
            stops = np.cumsum([len(w.encode()) + 1 for w in some])
            if not self._same(text.encode(), a, b):
                alone += some
                continue
            for ids, size, memo in ((a, self.size_a, self.ids_a), (b, self.size_b, self.ids_b)):
                ids = np.array(ids, "<i4")
                at = (np.searchsorted(np.cumsum(size[ids]), stops) + 1).tolist()
                packed = ids.tobytes()
                memo.update((w, packed[4 * lo:4 * hi]) for w, lo, hi in zip(some, [0, *at], at))
        for word, a, b in self._encode(alone):
            self.ids_a[word], self.ids_b[word] = (np.array(x, "<i4").tobytes() for x in (a, b))
            if not self._same(word.encode(), a, b):
                self.odd.add(word)

    def tokens(self, raws: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids by A of space + text and by B of the text; none where the texts
        are empty or the tokens' bytes are not space + text."""
        texts = [as_text(r) for r in raws]
        words = [self.words(t) if r else [] for t, r in zip(texts, raws)]
        if len(self.ids_a) > MEMO_WORDS:
            for memo in (self.ids_a, self.ids_b, self.odd):
                memo.clear()
        new = list(set().union(*words).difference(self.ids_a))
        self._learn(new)
        out = []
        for raw, text, some in zip(raws, texts, words):
            if self.odd and not self.odd.isdisjoint(some):
                (_, a, b), = self._encode([text])
                a, b = (np.array(x if self._same(raw, a, b) else [], "<i4").tobytes() for x in (a, b))
            else:
                a, b = (b"".join(map(ids.__getitem__, some)) for ids in (self.ids_a, self.ids_b))
            out.append((np.frombuffer(a, "<i4"), np.frombuffer(b, "<i4")))
        for word in new:
            if len(word) > MEMO_LENGTH:
                del self.ids_a[word], self.ids_b[word]
                self.odd.discard(word)
        return out


@lru_cache(maxsize=2)
def load_pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def _near(end_a, end_b, a_lo, a_hi, b_lo, b_hi, right: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each interval (A's tokens a_lo to a_hi, B's b_lo to b_hi, without
    the last): the shared cut next to the middle on one side, as the places of
    the two tokens that end there; -1 if there is none."""
    x = (np.where(a_lo > 0, end_a[a_lo - 1], 0) + end_a[a_hi - 1]) // 2 + (0 if right else -1)
    found_a, found_b = np.full(len(x), -1), np.full(len(x), -1)
    open_ = np.arange(len(x))
    for _ in range(LEAPS):
        if right:
            i = np.searchsorted(end_a, x[open_])
            j = np.searchsorted(end_b, end_a[i])
            inside = i < a_hi[open_] - 1
        else:
            i = np.searchsorted(end_a, x[open_], side="right") - 1
            j = np.searchsorted(end_b, end_a[i], side="right") - 1      # i = -1 reads the last end; not inside
            inside = (i >= a_lo[open_]) & (j >= b_lo[open_])
        open_, i, j = open_[inside], i[inside], j[inside]
        same = end_a[i] == end_b[j]
        found_a[open_[same]], found_b[open_[same]] = i[same], j[same]
        open_, j = open_[~same], j[~same]
        if not len(open_):
            return found_a, found_b
        x[open_] = end_b[j]
    for k in open_.tolist():        # many ends in turn and none shared: look the half's other ends up at once
        i = np.searchsorted(end_a, x[k]) if right else np.searchsorted(end_a, x[k], side="right") - 1
        ends = np.arange(i, a_hi[k] - 1) if right else np.arange(a_lo[k], i + 1)
        at = np.searchsorted(end_b, end_a[ends])
        shared = np.flatnonzero(end_b[at] == end_a[ends])
        if len(shared):
            one = shared[0 if right else -1]
            found_a[k], found_b[k] = ends[one], at[one]
    return found_a, found_b


def shared_cuts(end_a: np.ndarray, end_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray):
    """Places in A and in B of the tokens that end a group, in order.  The
    ends run on over all texts; the tokens in ``last_a`` and ``last_b`` end
    texts, where both always agree."""
    cuts_a, cuts_b = [last_a], [last_b]
    a_hi, b_hi = last_a + 1, last_b + 1
    a_lo, b_lo = np.concatenate(([0], a_hi[:-1])), np.concatenate(([0], b_hi[:-1]))
    while True:
        more = (a_hi - a_lo > 1) & (b_hi - b_lo > 1)
        a_lo, a_hi, b_lo, b_hi = a_lo[more], a_hi[more], b_lo[more], b_hi[more]
        if not len(a_lo):
            break
        i, j = _near(end_a, end_b, a_lo, a_hi, b_lo, b_hi, True)
        rest = np.flatnonzero(i < 0)
        i[rest], j[rest] = _near(end_a, end_b, a_lo[rest], a_hi[rest], b_lo[rest], b_hi[rest], False)
        cut = i >= 0
        i, j = i[cut], j[cut]
        cuts_a.append(i)
        cuts_b.append(j)
        # the two halves of each interval side by side: in order, so that looks stay near each other
        a_lo, a_hi = np.column_stack((a_lo[cut], i + 1)).ravel(), np.column_stack((i + 1, a_hi[cut])).ravel()
        b_lo, b_hi = np.column_stack((b_lo[cut], j + 1)).ravel(), np.column_stack((j + 1, b_hi[cut])).ravel()
    return np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))


def align(pair: Pair, tokens: list[tuple[np.ndarray, np.ndarray]]):
    """For a chunk of texts: per text n_a, n_b, n_groups, n_links and the
    digest of its groups; and the id pair, a * size of B + b, of each link of
    the chunk, in order.

    Tokens whose bytes overlap are linked, and every cut of either tokenizer
    ends exactly one link, so the links are read off the merged ends."""
    n_a, n_b = (np.array([len(t[k]) for t in tokens], np.int64) for k in (0, 1))
    filled = n_a > 0
    zeros = np.zeros(len(tokens), np.int64)
    digests = [""] * len(tokens)
    if not filled.any():
        return n_a, n_b, zeros, zeros, digests, np.zeros(0, np.int64)
    a, b = (np.concatenate([t[k] for t in tokens]).astype(np.int64) for k in (0, 1))
    end_a, end_b = np.cumsum(pair.size_a[a]), np.cumsum(pair.size_b[b])
    stop_a, stop_b = np.cumsum(n_a), np.cumsum(n_b)
    cut_a, cut_b = shared_cuts(end_a, end_b, stop_a[filled] - 1, stop_b[filled] - 1)
    n_groups = np.diff(np.searchsorted(cut_a, stop_a), prepend=0)
    cuts = np.sort(np.concatenate((end_a, end_b)), kind="stable")
    cuts = cuts[np.append(cuts[1:] != cuts[:-1], True)]
    n_links = np.zeros(len(tokens), np.int64)
    n_links[filled] = np.diff(np.searchsorted(cuts, end_a[stop_a[filled] - 1], side="right"), prepend=0)
    pairs = a[np.searchsorted(end_a, cuts)] * len(pair.bytes_b) + b[np.searchsorted(end_b, cuts)]
    # each group's ids of A, then its ids of B
    last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    last_a[cut_a] = last_b[cut_b] = 1
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    b_before = np.concatenate(([0], cut_b + 1))
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + b_before[group_a]] = a + last_a * pair.written_step
    order[np.arange(len(b)) + (cut_a + 1)[group_b]] = b + 2 * last_b * pair.written_step
    written, at = pair.written, 0
    for k, n in enumerate((n_a + n_b).tolist()):
        if n:
            digest = hashlib.sha256()
            for lo in range(at, at + n, HASHED):
                part = b"".join(map(written.__getitem__, order[lo:min(lo + HASHED, at + n)].tolist()))
                digest.update(part if lo + HASHED < at + n else part[:-1])
            digests[k] = digest.hexdigest()
            at += n
    return n_a, n_b, n_groups, n_links, digests, pairs


def pack_places(places: np.ndarray, n: int) -> bytes:
    """Places among n pairs, small: they travel with their texts' rows, which
    Spark keeps whole in memory.  The first byte tells their width."""
    width = 2 if n <= 1 << 16 else 4
    return bytes([width]) + pa.compress(places.astype(f"<u{width}").tobytes(), codec="zstd", asbytes=True)


def unpack_places(packed: bytes, n: int) -> np.ndarray:
    """n places as ``pack_places`` wrote them."""
    return np.frombuffer(pa.decompress(packed[1:], n * packed[0], codec="zstd", asbytes=True), f"<u{packed[0]}")


def _chunks(path_a: str, path_b: str, kind: pa.DataType):
    names = ["chunk", "ids", "n_a", "n_b", "n_groups", "n_links", "digests", "pairs", "n", "places"]

    def row(chunk: int, ids: pa.Array, raws: list[bytes]) -> pa.RecordBatch:
        pair = load_pair(path_a, path_b)
        *counts, digests, links = align(pair, pair.tokens(raws))
        pairs, places, n = np.unique(links, return_inverse=True, return_counts=True)
        one = lambda x, t: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, t))
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk], pa.int64()), one(ids, kind), *(one(c, pa.int64()) for c in counts), one(digests, pa.string()),
             one(pairs, pa.int64()), one(n, pa.int64()), pa.array([pack_places(places, len(pairs))], pa.binary())], names=names)

    def run(batches):
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            start, raws, size = 0, [], 0
            for k, x in enumerate(batch.column(1)):
                raws.append(x.as_py())
                size += len(raws[-1])
                if size >= CHUNK_BYTES or k + 1 == batch.num_rows:
                    yield row(chunk, batch.column(0).slice(start, len(raws)), raws)
                    chunk, start, raws, size = chunk + 1, k + 1, [], 0
    return run


def _counted(kind: pa.DataType, id_col: str):
    """Rows of documents from chunks with the corpus's counts of their pairs."""
    def run(batches):
        load_pair.cache_clear()         # the worker that aligned keeps nothing of it
        for batch in batches:
            for k in range(batch.num_rows):
                ids, n_a, n_b, n_groups, n_links, digests, places, rated = (batch.column(c)[k] for c in range(1, 9))
                per_doc = np.asarray(n_links.values)
                best, total = np.zeros(len(per_doc), np.int64), np.zeros(len(per_doc), np.int64)
                if per_doc.any():
                    at = unpack_places(places.as_py(), int(per_doc.sum()))
                    counts = np.asarray(rated.values.field("count"))[at]
                    highest = np.asarray(rated.values.field("best"))[at]
                    first = (np.cumsum(per_doc) - per_doc)[per_doc > 0]
                    best[per_doc > 0] = np.add.reduceat(highest, first, dtype=np.int64)
                    total[per_doc > 0] = np.add.reduceat(counts, first)
                yield pa.RecordBatch.from_arrays(
                    [ids.values.cast(kind), n_a.values, n_b.values, n_groups.values, n_links.values, pa.array(best),
                     pa.array(total), digests.values],
                    names=[id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
            pa.default_memory_pool().release_unused()
    return run


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n_a, n_b (tokens), n_groups, n_links, n_best,
    count_sum, groups_sha256.

    A is a byte-level BPE (a ``tokenizers`` file) over space + text, B a
    SentencePiece model over the text, which adds the space.  NULL and empty
    texts, and texts whose tokens' bytes differ from space + text, have no
    tokens: zeros and an empty digest.  An id pair's count is the number of
    links that hold it in all rows of ``docs``, repeated rows included;
    n_best counts a row's links whose pair has the largest count of all pairs
    with its B id, ties included; count_sum adds the counts of a row's links.
    Equal and NULL ids are rows each, ids are of the types in ``ARROW``; other
    columns are ignored; an empty table stays empty.
    """
    from sentencepiece import SentencePieceProcessor

    name = id_type(docs, id_col)
    arrow = ARROW[name]
    size_b = SentencePieceProcessor(model_file=path_b).get_piece_size()
    long = "array<bigint>"
    chunks = materialize(docs.select(F.col(f"`{id_col}`"), utf8(text_col).alias("utf8")).mapInArrow(
        _chunks(path_a, path_b, arrow), f"chunk bigint, ids array<{name}>, n_a {long}, n_b {long}, n_groups {long},"
        f" n_links {long}, digests array<string>, pairs {long}, n {long}, places binary"), "alignment-chunks")
    totals = materialize(chunks.select(F.explode(F.arrays_zip("pairs", "n")).alias("x")).groupBy(
        F.col("x.pairs").alias("pair")).agg(F.sum("x.n").alias("count")), "alignment-pairs")
    # one row for each id of B: bounded by the vocabulary, so small enough to broadcast however large the corpus
    most = totals.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("count").alias("most"))
    rated = totals.join(F.broadcast(most), F.col("pair") % size_b == F.col("b")).select(
        "pair", "count", (F.col("count") == F.col("most")).alias("best"))
    asked = chunks.select("chunk", F.explode("pairs").alias("pair")).join(rated, "pair").groupBy("chunk").agg(
        F.sort_array(F.collect_list(F.struct("pair", "count", "best"))).alias("rated"))
    return chunks.select("chunk", "ids", "n_a", "n_b", "n_groups", "n_links", "digests", "places").join(
        asked, "chunk", "left").mapInArrow(
        _counted(arrow, id_col), f"`{id_col}` {name}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint,"
        " n_best bigint, count_sum bigint, groups_sha256 string")
