"""Byte-level BPE by monoid tree reduction.

Encodings of byte strings form a monoid: ``join(encode(a), encode(b)) ==
encode(a + b)``.  A string is halved down to its bytes and encoded by joining
the halves, level by level; all strings of a batch are joined together.

A sequence of tokens is the encoding of its bytes exactly if each pair of
neighbours is the encoding of the pair's bytes.  So a join looks at the two
tokens at the seam.  If they are stable side by side, the halves are simply
put together.  Otherwise a window around the seam is encoded anew, one token
to either side at first, and grown by as many again on a side until the token
just outside is stable beside it.

Whether two tokens are stable is read off the vocabulary: going back in time
from the pair, the token that was merged last is undone, and no merge across
the seam may come before the merge that is undone.  Decoding concatenates up
the same tree.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import as_text, id_type, utf8

SHORT_BYTES = 16         # so short windows are merged by scanning, longer ones with a heap
WINDOWS = 200_000        # remembered windows
MEMO_WORDS, MEMO_LENGTH = 250_000, 64   # stretches whose ids a worker remembers, and their longest
BATCH_BYTES = 2 << 20    # of texts encoded together
NEVER = np.iinfo(np.int64).max
WHITE = [c for c in map(chr, range(0x3001)) if c.isspace()]
CUT = re.compile(r"(?<=\S) (?=\S)")


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after another."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


class ByteBPE:
    """Ranks of a byte-level vocabulary; merging always takes the pair with
    the lowest rank, leftmost first."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        n = max(self.bytes_of) + 1
        self.size = np.zeros(n, np.int64)
        self.size[list(self.bytes_of)] = [len(b) for b in self.bytes_of.values()]
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.windows: dict[bytes, tuple[int, ...]] = {}
        self.joins = self.unstable = 0      # seams looked at, and those whose window was encoded anew
        self._learn_merges(n)

    def _learn_merges(self, n: int) -> None:
        """Every pair of tokens whose bytes together are a token, and for each
        token the pair that its own encoding merges last."""
        pairs, self.left, self.right = [], np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        self.time = np.full(n, -1, np.int64)        # when a token is made: its rank; bytes are there from the start
        self.ordered = True
        for token, rank in sorted(self.ranks.items(), key=lambda x: x[1]):
            if len(token) == 1:
                continue
            found = [(self.ranks[token[:k]], self.ranks[token[k:]]) for k in range(1, len(token))
                     if token[:k] in self.ranks and token[k:] in self.ranks]
            pairs += [(a * n + b, rank) for a, b in found]
            parts = self._merge(token, below=rank)
            if len(parts) == 2 and max(self.time[parts]) < rank:
                self.left[rank], self.right[rank], self.time[rank] = *parts, rank
            else:
                self.ordered = False                # times cannot be read off this vocabulary
        pairs.sort()
        self.pair_keys = np.array([k for k, _ in pairs], np.int64)
        self.pair_ranks = np.array([r for _, r in pairs], np.int64)
        self.byte_pairs = np.full((256, 256), -1, np.int64)     # tokens of two bytes
        for token, rank in self.ranks.items():
            if len(token) == 2:
                self.byte_pairs[token[0], token[1]] = rank

    def _merge(self, data: bytes, below: int = 1 << 62) -> list[int]:
        """Direct encoding; with ``below`` by merges of lower rank only."""
        return self._merge_scan(data, below) if len(data) <= SHORT_BYTES else self._merge_heap(data, below)

    merge = _merge

    def _merge_scan(self, data: bytes, none: int) -> list[int]:
        ranks, parts = self.ranks, [data[i:i + 1] for i in range(len(data))]
        rank = ranks.get
        pairs = [rank(data[i:i + 2], none) for i in range(len(data) - 1)]  # of each part and its right neighbour
        while pairs and (least := min(pairs)) < none:
            i = pairs.index(least)
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], none)
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], none)
        return [ranks[p] for p in parts]

    def _merge_heap(self, data: bytes, none: int) -> list[int]:
        """With a heap of adjacent pairs, O(n log n)."""
        n = len(data)
        end = list(range(1, n + 1))        # end[i]: end of the part that starts at i
        prev = list(range(-1, n - 1))
        alive = bytearray(b"\x01") * n
        ranks = self.ranks
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i:i + 2], none)) < none]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or (j := end[i]) >= n or not alive[j] or end[j] != stop:
                continue
            alive[j] = 0
            end[i] = stop
            if stop < n:
                prev[stop] = i
                if (r := ranks.get(data[i:end[stop]], none)) < none:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (p := prev[i]) >= 0 and (r := ranks.get(data[p:stop], none)) < none:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i:end[i]]])
            i = end[i]
        return out

    def _merged_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * len(self.size) + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER)

    def stable(self, a: np.ndarray, b: np.ndarray, apart: bool = False) -> np.ndarray:
        """Whether a, b side by side are the encoding of their bytes; ``apart``
        if it is known that their bytes together are no token."""
        if not self.ordered:
            return np.array([self._window(self.bytes_of[x] + self.bytes_of[y]) == (x, y)
                             for x, y in zip(a.tolist(), b.tolist())], bool)
        out, at = np.ones(len(a), bool), np.arange(len(a))
        limit = np.full(len(a), NEVER)
        while len(at):
            crosses = np.zeros(len(at), bool) if apart else self._merged_rank(a, b) < limit
            apart = False
            out[at[crosses]] = False
            made_a, made_b = self.time[a], self.time[b]
            go = ~crosses & ((made_a >= 0) | (made_b >= 0))
            at, a, b, made_a, made_b = at[go], a[go], b[go], made_a[go], made_b[go]
            later_a = made_a > made_b       # of two equal tokens the right one is made later
            # undoing a, a merge of its rank came after it (further right); undoing b, before it
            limit = np.where(later_a, made_a, made_b + 1)
            a, b = np.where(later_a, self.right[a], a), np.where(later_a, b, self.left[b])
        return out

    def _window(self, data: bytes) -> tuple[int, ...]:
        if (known := self.windows.get(data)) is None:
            if len(self.windows) > WINDOWS:
                self.windows.clear()
            known = tuple(self._merge(data))
            if len(data) <= MEMO_LENGTH:
                self.windows[data] = known
        return known

    def tree(self, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all strings, one after another; number of each string's)."""
        size = np.array(list(map(len, strings)), np.int64)
        data = b"".join(strings)
        raw = np.frombuffer(data, np.uint8)
        token = self.byte_id[raw]                               # at the byte where a token starts; -1 elsewhere
        begin = np.arange(len(data))                            # at the byte where a token ends: where it starts
        levels, lo, hi = [], np.cumsum(size) - size, np.cumsum(size)
        while len(lo := lo[(cut := hi - lo > 1)]):
            hi = hi[cut]
            seam = (lo + hi) // 2
            levels.append((lo, seam, hi))
            lo, hi = np.column_stack((lo, seam)).ravel(), np.column_stack((seam, hi)).ravel()
        for lo, seam, hi in reversed(levels):
            self._join(data, raw, token, begin, lo, seam, hi)
        held = np.flatnonzero(token >= 0)
        return token[held], np.diff(np.searchsorted(held, np.cumsum(size)), prepend=0)

    def _join(self, data: bytes, raw: np.ndarray, token: np.ndarray, begin: np.ndarray, lo: np.ndarray,
              seam: np.ndarray, hi: np.ndarray) -> None:
        """Joins the halves [lo, seam) and [seam, hi) of each node, in place."""
        self.joins += len(seam)
        two = hi - lo == 2      # of two bytes: they are a token, or stay
        at = lo[two]
        made = self.byte_pairs[raw[at], raw[at + 1]]
        at, made = at[made >= 0], made[made >= 0]
        token[at], token[at + 1], begin[at + 1] = made, -1, at
        self.unstable += len(at)
        lo, seam, hi = lo[~two], seam[~two], hi[~two]
        start = begin[seam - 1]
        a, b = token[start], token[seam]
        stop = seam + self.size[b]
        # where both tokens together are a token, that is the window's encoding
        one = self._merged_rank(a, b) if self.ordered else np.full(len(lo), NEVER)
        loose = one != NEVER
        loose[~loose] = ~self.stable(a[~loose], b[~loose], apart=self.ordered)
        self.unstable += int(loose.sum())
        lo, hi, start, stop, one = lo[loose], hi[loose], start[loose], stop[loose], one[loose]
        grow_left, grow_right = np.ones(len(lo), np.int64), np.ones(len(lo), np.int64)
        while len(lo):
            read = np.flatnonzero(one == NEVER)
            found = [self._window(data[x:y]) for x, y in zip(start[read].tolist(), stop[read].tolist())]
            count = np.ones(len(lo), np.int64)
            count[read] = list(map(len, found))
            first = np.cumsum(count) - count
            ids = np.repeat(one, count)
            ids[ranges(first[read], count[read])] = list(chain.from_iterable(found))
            sizes = self.size[ids]
            run = np.cumsum(sizes) - sizes
            at = run - np.repeat(run[first] - start, count)
            token[ranges(start, stop - start)] = -1
            token[at] = ids
            begin[at + sizes - 1] = at
            left, right = start > lo, stop < hi
            left[left] = ~self.stable(token[begin[start[left] - 1]], ids[first][left])
            last = ids[first + count - 1]
            right[right] = ~self.stable(last[right], token[stop[right]])
            more = left | right
            lo, hi, start, stop, left, right = lo[more], hi[more], start[more], stop[more], left[more], right[more]
            grow_left, grow_right, one = grow_left[more], grow_right[more], np.full(len(lo), NEVER)
            for side, grow, edge, end in ((left, grow_left, start, lo), (right, grow_right, stop, hi)):
                going, steps = side.copy(), grow.copy()
                while (going := going & (steps > 0) & (edge != end)).any():
                    edge[going] = begin[edge[going] - 1] if end is lo else edge[going] + self.size[token[edge[going]]]
                    steps[going] -= 1
                grow[side] *= 2

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The monoid's operation on two encodings; [] is its unit."""
        if not left or not right:
            return left or right
        data, ids = self.decode(left + right), np.array(left + right, np.int64)
        end = np.cumsum(self.size[ids])
        token, begin = np.full(len(data), -1), np.zeros(len(data), np.int64)
        token[end - self.size[ids]], begin[end - 1] = ids, end - self.size[ids]
        at = [np.array([x]) for x in (0, end[len(left) - 1], len(data))]
        self._join(data, np.frombuffer(data, np.uint8), token, begin, *at)
        return token[token >= 0].tolist()

    def encode(self, data: bytes) -> list[int]:
        """One match of the split pattern; a match that is a token is that token."""
        if (whole := self.ranks.get(data)) is not None:
            return [whole]
        return self.tree([data])[0].tolist()

    def decode(self, ids: list[int]) -> bytes:
        """Concatenates neighbours up the tree."""
        parts = list(map(self.bytes_of.__getitem__, ids))
        while len(parts) > 1:
            odd = parts[-1:] if len(parts) % 2 else []
            parts = [a + b for a, b in zip(parts[::2], parts[1::2])] + odd
        return parts[0] if parts else b""


class TextCodec:
    """Whole texts: every match of the split pattern is encoded separately
    and the results are concatenated.

    ``space_starts`` says that in a text a space after other than white space,
    and before it, always begins a match (patterns that take white space before
    a word as that one space only): stretches from such a space to the next are
    then split by themselves, and their results remembered."""

    def __init__(self, path: str, pattern: str, space_starts: bool):
        with open(path, "rb") as f:
            self.bpe = ByteBPE({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})
        self.matches = regex.compile(pattern).findall
        self.space_starts = space_starts
        self.single = {b: i.to_bytes(4, "little") for b, i in self.bpe.ranks.items()}
        self.memo: dict[str, bytes] = {}

    def stretches(self, text: str) -> list[str]:
        """The text in stretches, each after the first without its space."""
        if not self.space_starts:
            return [text]
        single = not (text.startswith(" ") or text.endswith(" ") or any(
            c in text and (c + " " in text or " " + c in text) for c in WHITE))
        return text.split(" ") if single else CUT.split(text)

    def _learn(self, new: list[str]) -> list[bytes]:
        """The packed ids of whole texts or stretches that may follow each
        other; the matches that are no tokens are encoded together."""
        found = [m.encode("utf-8") for m in self.matches("".join(new))]
        unknown = list({m for m in found if m not in self.single})
        ids, count = self.bpe.tree(unknown)
        packed, stop = ids.astype("<u4").tobytes(), (4 * np.cumsum(count)).tolist()
        known = {m: packed[a:b] for m, a, b in zip(unknown, [0, *stop], stop)}
        single = self.single.get
        ids_of = [single(m) or known[m] for m in found]
        # matches end where the stretches end
        ends = np.searchsorted(np.cumsum(list(map(len, found))), np.cumsum([len(s.encode("utf-8")) for s in new])) + 1
        whole, at = b"".join(ids_of), np.append(0, np.cumsum(list(map(len, ids_of))))
        cuts = [0, *at[ends].tolist()]
        return [whole[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        parts = [self.stretches(t) if t else [] for t in texts]
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        new = list(set().union(*(p[1:] for p in parts)).difference(self.memo))
        inner = [s for s in new if not s[-1:].isspace()]        # another may follow
        self.memo.update(zip(inner, self._learn([" " + s for s in inner])))
        alone = [s for s in new if s[-1:].isspace()]
        self.memo.update((s, self._learn([" " + s])[0]) for s in alone)
        # first stretches stand alone; a line end, which is a match of its own between other characters, parts them
        firsts = {p[0] for p in parts if p}
        plain = [s for s in firsts if self.space_starts and s == s.strip()]
        first = dict(zip(plain, self._learn([x for s in plain for x in (s, "\n")])[::2]))
        first |= {s: self._learn([s])[0] for s in firsts.difference(first)}
        packed = [b"".join((first[p[0]], *map(self.memo.__getitem__, p[1:]))) if p else b"" for p in parts]
        for s in new:
            if len(s) > MEMO_LENGTH:
                del self.memo[s]
        return packed

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> bytes:
        return self.bpe.decode(np.frombuffer(ids, dtype="<u4").tolist())


@lru_cache(maxsize=2)
def load_codec(path: str, pattern: str, space_starts: bool = False) -> TextCodec:
    """Vocabulary and memos, kept for the tasks that a worker runs."""
    return TextCodec(path, pattern, space_starts)


def _encoded(batches, codec: TextCodec):
    """(ids column, list of packed ids) for slices of about BATCH_BYTES."""
    for batch in batches:
        start, some, size = 0, [], 0
        for k, x in enumerate(batch.column(1)):
            some.append(as_text(x.as_py()))
            size += len(some[-1])
            if size >= BATCH_BYTES or k + 1 == batch.num_rows:
                yield batch.column(0).slice(start, len(some)), codec.encode_all(some)
                start, some, size = k + 1, [], 0


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     space_starts: bool = False) -> DataFrame:
    """(id, ids binary): each whole text as packed little-endian 32-bit ids.

    NULL and empty texts give no ids.  Repeated rows and equal ids are encoded
    row by row; further columns of ``docs`` are ignored; an empty table gives
    an empty table.  No shuffle: the work is one pass over the scan.
    ``space_starts`` may be given for patterns of which ``TextCodec`` says so.
    """
    def run(batches):
        for ids, packed in _encoded(batches, load_codec(path, pattern, space_starts)):
            yield pa.RecordBatch.from_arrays([ids, pa.array(packed, pa.binary())], names=[id_col, "ids"])

    return docs.select(F.col(f"`{id_col}`"), utf8(text_col).alias("_utf8")).mapInArrow(
        run, f"`{id_col}` {id_type(docs, id_col)}, ids binary")


def decode_documents(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """(id, utf8 binary) from ``encode_documents``; NULL ids give no bytes."""
    def run(batches):
        codec = load_codec(path, pattern)
        for b in batches:
            parts = [codec.decode(x.as_py() or b"") for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(parts, type=pa.binary())],
                                             names=[id_col, "utf8"])

    return encoded.select(F.col(f"`{id_col}`"), F.col("ids")).mapInArrow(
        run, f"`{id_col}` {id_type(encoded, id_col)}, utf8 binary")


def digest_documents(docs: DataFrame, path: str, pattern: str, space_starts: bool = False) -> DataFrame:
    """Per document: n_tokens, SHA-256 of the packed ids and of the bytes
    that the ids decode to (encode and decode in one pass)."""
    def run(batches):
        codec = load_codec(path, pattern, space_starts)
        for ids, packed in _encoded(batches, codec):
            decoded = [hashlib.sha256(codec.decode(x)).hexdigest() for x in packed]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([len(x) // 4 for x in packed], pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in packed]), pa.array(decoded)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", utf8().alias("_utf8")).mapInArrow(
        run, f"doc_id {id_type(docs, 'doc_id')}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
