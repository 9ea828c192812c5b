"""Concatenate and cut: packing of tokenised documents into fixed windows.

Pass one tokenises every document once, writes the ids with each document's
offset within its input partition to the shared folder, and sums the tokens
of each partition.  A prefix sum over these totals (one number a partition)
turns local into global offsets.  Pass two cuts the stream of all documents
at multiples of the window length: a document that crosses a cut leaves one
piece in each window, with boundary records of where it continues.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import accumulate, chain, groupby, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import as_text, id_type, materialize, utf8

MEMO_WORDS = 250_000   # words whose ids a worker remembers
MEMO_PARTS = 400_000   # parts of words, likewise
STEP = 1024            # documents tokenised together
STEP_BYTES = 1 << 22   # of their texts, about
RUN = 1 << 15          # words whose ids are gathered together

# Characters whose lower case and normal form are known to be one character
# each, so that words between white space can be tokenised by themselves.
SIMPLE = re.compile("[\t\n\r -~À-ÖØ-öø-įĲ-ſ]*").fullmatch

# What is left of them in lower case, but white space.
SIMPLE_SIGNS = sorted({c.lower() for k in range(33, 384) if SIMPLE(c := chr(k))})

# Fixed value: the tokenizer's own split, for simple characters in lower case.
SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^\\sa-zß-öø-ſ0-9]+").findall


# Words of every kind that ``SPLIT`` tells apart, and every simple sign: the memo
# is used only with tokenizers that make the same of them one by one as in a text.
PROBE = "It's we'LL 12 3a don't e.g. co-op!! (x) ÀÉ über-groß a1b2 ''s 'tis !? " + " ".join(SIMPLE_SIGNS)


def _grown(values: np.ndarray, used: int, new: np.ndarray) -> np.ndarray:
    """``values`` with ``new`` behind the first ``used``; room is doubled where it ends."""
    if used + len(new) > len(values):
        values = np.concatenate([values[:used], np.zeros(used + 2 * len(new), values.dtype)])
    values[used:used + len(new)] = new
    return values


class WordTokens:
    """Ids of whole texts, as the tokenizer gives them as it is loaded.  It
    never joins across white space, so in texts of simple characters each word
    is tokenised once and remembered; any other text, and any that holds the
    string of an added token, goes to the tokenizer as a whole.  So does every
    text with a tokenizer for which this does not hold on ``PROBE``.

    The parts of a simple word need no normalisation any more, so they go to
    the tokenizer's model in the characters of its pre-tokenizer's alphabet.
    The ids of all remembered words stand in one array, from which those of
    many texts are taken at once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model, split = self.tokenizer.model, self.tokenizer.pre_tokenizer
        self.alphabet = {} if split is None else {
            ord(c): "".join(x for x, _ in split.pre_tokenize_str(c)) for c in SIMPLE_SIGNS}
        self.parts: dict[str, bytes] = {}    # of what the split makes of words
        self._forget()
        self.by_word = True
        self.by_word = self.encode([PROBE])[0] == self._whole(PROBE)

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}       # numbers of words between white space
        self.ids = np.zeros(0, self.dtype)   # of word k: from bounds[k] to bounds[k + 1]
        self.bounds = np.zeros(1, np.int64)

    def _whole(self, text: str) -> bytes:
        return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _simple(self, text: str) -> str | None:
        """The text in lower case, where its words can be taken one by one."""
        if not self.by_word or not SIMPLE(text):
            return None
        low = text.lower()
        return None if any(x in low for x in self.added) else low

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def _learn(self, parts: list[str]) -> None:
        tokenize = self.model.tokenize
        ids = [[t.id for t in tokenize(p.translate(self.alphabet))] for p in parts]
        packed, size = self._pack(list(chain.from_iterable(ids))), self.dtype.itemsize
        cuts = list(accumulate((size * len(x) for x in ids), initial=0))
        self.parts.update((p, packed[cuts[k]:cuts[k + 1]]) for k, p in enumerate(parts))

    def _remember(self, words: list[str]) -> None:
        split = list(map(SPLIT, words))
        if unknown := list(set().union(*split).difference(self.parts)):
            self._learn(unknown)
        packed = [b"".join(map(self.parts.__getitem__, p)) for p in split]
        known, used = len(self.memo), int(self.bounds[len(self.memo)])
        ends = used + np.cumsum(np.fromiter(map(len, packed), np.int64, len(packed))) // self.dtype.itemsize
        self.ids = _grown(self.ids, used, np.frombuffer(b"".join(packed), self.dtype))
        self.bounds = _grown(self.bounds, known + 1, ends)
        self.memo.update(zip(words, range(known, known + len(words))))

    def _numbers(self, words: list[str]) -> np.ndarray:
        at = np.fromiter(map(self.memo.get, words, repeat(-1)), np.int64, len(words))
        if unknown := np.flatnonzero(at < 0).tolist():
            known = len(self.memo)
            self._remember([words[k] for k in unknown])
            at[unknown] = np.arange(known, known + len(unknown))
        return at

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.memo) > MEMO_WORDS:
            self._forget()                   # the parts, which are fewer and cost more, stay
        if len(self.parts) > MEMO_PARTS:
            self.parts.clear()
        simple = list(map(self._simple, texts))
        words = pc.ascii_split_whitespace(pa.array([x for x in simple if x is not None], pa.large_string()))
        distinct = words.flatten().dictionary_encode()
        at = self._numbers(distinct.dictionary.to_numpy(zero_copy_only=False).tolist())[distinct.indices.to_numpy()]
        first = self.bounds[at]
        n = self.bounds[at + 1] - first
        stops = np.cumsum(n)
        raw = b"".join(self.ids[np.repeat((first - stops + n)[k:k + RUN], n[k:k + RUN])
                                + np.arange(stops[k] - n[k], stops[min(k + RUN, len(n)) - 1])].tobytes()
                       for k in range(0, len(n), RUN))
        ends = np.concatenate([[0], stops])[words.offsets.to_numpy()] * self.dtype.itemsize
        found = map(raw.__getitem__, map(slice, ends[:-1].tolist(), ends[1:].tolist()))
        return [self._whole(t) if x is None else next(found) for t, x in zip(texts, simple)]


@lru_cache(maxsize=2)
def _tokens(path: str) -> WordTokens:
    return WordTokens(path)


def _steps(texts: pa.Array):
    """(first row, rows) of runs of at most ``STEP`` rows and, but for the last row, ``STEP_BYTES``."""
    sizes = np.asarray(pc.binary_length(texts), np.int64)
    before = np.cumsum(sizes) - sizes
    for _, rows in groupby(range(len(sizes)), lambda k: (k // STEP, int(before[k]) // STEP_BYTES)):
        first, *rest = rows
        yield first, 1 + len(rest)


def tokenize(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Pass one, written to the shared folder: (part, local_start, n_tokens,
    id, ids); ids end with ``end_id``."""
    def run(batches):
        words = _tokens(tokenizer_path)
        end = words._pack([end_id])
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            for k, rows in _steps(batch.column(1)):
                some = batch.slice(k, rows)
                ids = [x + end for x in words.encode([as_text(x.as_py()) for x in some.column(1)])]
                n = [len(x) // words.dtype.itemsize for x in ids]
                starts = list(accumulate(n, initial=at))
                at = starts.pop()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(n), pa.int32()), pa.array(starts, pa.int64()), pa.array(n, pa.int64()),
                     some.column(0), pa.array(ids, pa.binary())],
                    names=["part", "local_start", "n_tokens", "id", "ids"])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), utf8(text_col).alias("_utf8")).mapInArrow(
        run, f"part int, local_start bigint, n_tokens bigint, id {id_type(docs, id_col)}, ids binary")
    return materialize(rows, "packing-tokens")


def cut(tokens: DataFrame, window: int, id_col: str = "doc_id") -> DataFrame:
    """Pass two, one row per piece: id, start, length, doc_tokens,
    sequence_id, offset, continues (a boundary follows within the document),
    ids (packed as little-endian unsigned 32-bit integers).

    Only the partitions' totals, one number each, come to the driver.
    """
    totals = sorted((r["part"], r["n"]) for r in
                    tokens.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    base = dict(zip([p for p, _ in totals], accumulate((n for _, n in totals), initial=0)))
    names = [id_col, "start", "length", "doc_tokens", "sequence_id", "offset", "continues", "ids"]

    def run(batches):
        for batch in batches:
            rows = []
            for part, local, n, doc, ids in zip(*(c.to_pylist() for c in batch.columns)):
                first, done = base[part] + local, 0
                # in 16 or 32 bits each, as the vocabulary needs
                packed = ids if len(ids) == 4 * n else np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                while done < n:
                    sequence, offset = divmod(first + done, window)
                    length = min(n - done, window - offset)
                    rows.append((doc, done, length, n, sequence, offset, done + length < n,
                                 packed[4 * done:4 * (done + length)]))
                    done += length
            cols = list(zip(*rows)) if rows else [[]] * 8
            kinds = [batch.schema.field(3).type, *[pa.int64()] * 5, pa.bool_(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=names)

    return tokens.mapInArrow(run, f"`{id_col}` {id_type(tokens, 'id')}, start bigint, length bigint, doc_tokens bigint,"
                                  " sequence_id bigint, offset bigint, continues boolean, ids binary")


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = 4096, end_id: int = 2,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents in windows of ``window`` tokens; only the last
    window needs padding.

    NULL and empty texts are one piece of the end id; repeated rows are packed
    each; an empty table has no pieces; further columns are ignored.  Nothing
    is shuffled but one number a partition.
    """
    return cut(tokenize(docs, tokenizer_path, end_id, id_col, text_col), window, id_col=id_col)


def digest_pieces(pieces: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.select(f"`{id_col}`", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "continues")
