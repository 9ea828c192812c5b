"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are embedded; learned filters slide over overlapping
chunks that cover the whole document; their responses are max-pooled over the
document and combined into one probability.  A second bank of filters sees,
for overlapping chunks too, how often a byte equals the byte some way back,
which shows repeated words whatever the words are.

Training takes a bounded sample of labelled rows (``TRAIN_ROWS`` rows of at
most ``TRAIN_BYTES`` bytes); scoring reads every byte of every document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import id_type, utf8

TRAIN_ROWS, TRAIN_BYTES, STEPS, BATCH = 2500, 20_000, 320, 32
EMBED, WIDTH, STRIDE, FILTERS = 4, 12, 4, 16           # byte filters: chunks of 12 bytes, every 4
LAGS, BLOCK, REPEAT_FILTERS = 16, 32, 6                # repetition: chunks of two blocks of 32 bytes
SPAN = 1 << 16                                         # bytes in memory at a time, for long texts
HELD_OUT, FOLDS = 0, 5
THRESHOLD = 0.3


def _chunks(data: np.ndarray) -> np.ndarray:
    """Byte codes of the overlapping chunks, zero-padded at the end."""
    n = max(1, -(-max(0, len(data) - WIDTH) // STRIDE) + 1)
    padded = np.zeros((n - 1) * STRIDE + WIDTH, np.uint8)
    padded[:len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(padded, WIDTH)[::STRIDE]


def _repeats(data: np.ndarray, before: int = 0) -> np.ndarray:
    """For overlapping chunks of two blocks, the share of bytes equal to the
    byte 2..LAGS+1 back; the first ``before`` bytes are only looked back at."""
    size = len(data) - before
    n = max(2, -(-size // BLOCK))
    same = np.zeros((LAGS, n * BLOCK), np.uint8)
    for k in range(LAGS):
        first = max(before, k + 2)           # the first byte with one so far back
        if len(data) > first:
            np.equal(data[first:], data[first - k - 2:len(data) - k - 2], out=same[k, first - before:size].view(bool))
    block = same.reshape(LAGS, n, BLOCK).sum(axis=2, dtype=np.float32)
    return ((block[:, 1:] + block[:, :-1]) / (2 * BLOCK)).T


class ByteConvNet:
    """Weights in ``p``; all arrays are float32."""

    def __init__(self, seed: int = 7):
        g = np.random.default_rng(seed)

        def w(*shape, fan):
            return (g.standard_normal(shape) * np.sqrt(2 / fan)).astype(np.float32)

        both = FILTERS + REPEAT_FILTERS
        self.p = {
            "embed": w(256, EMBED, fan=2), "conv": w(WIDTH * EMBED, FILTERS, fan=WIDTH * EMBED),
            "conv_b": np.zeros(FILTERS, np.float32), "rep": w(LAGS, REPEAT_FILTERS, fan=2),
            "rep_b": np.zeros(REPEAT_FILTERS, np.float32), "out": w(both, fan=both),
            "out_b": np.full(1, 1.0, np.float32),
        }

    def _responses(self, data: np.ndarray) -> tuple:
        p, codes = self.p, _chunks(data)
        x = p["embed"][codes].reshape(len(codes), -1)
        rep = _repeats(data)
        return codes, x, x @ p["conv"], rep, rep @ p["rep"]

    def pooled(self, data: np.ndarray) -> np.ndarray:
        """Max-pooled responses of a whole text, span by span; consecutive
        spans overlap so that every chunk lies whole in one of them."""
        p, best, overlap = self.p, None, 2 * BLOCK
        table = p["embed"]
        for at in range(0, max(1, len(data)), SPAN - overlap):
            part = data[at:at + SPAN]
            codes = _chunks(part)
            a = (table[codes].reshape(len(codes), -1) @ p["conv"]).max(axis=0) + p["conv_b"]
            back = min(at, LAGS + 1)
            b = (_repeats(data[at - back:at + SPAN], back) @ p["rep"]).max(axis=0) + p["rep_b"]
            both = np.concatenate([a, b])
            best = both if best is None else np.maximum(best, both)
        return np.maximum(best, 0)

    def score(self, data: np.ndarray) -> float:
        z = float(self.pooled(data) @ self.p["out"] + self.p["out_b"][0])
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def fit(self, texts: list[bytes], labels: list[int], steps: int = STEPS, seed: int = 11) -> ByteConvNet:
        """Adam on the log-loss; gradients flow through each filter's best chunk."""
        g = np.random.default_rng(seed)
        data = [np.frombuffer(t, np.uint8) for t in texts]
        p = self.p
        m = {k: np.zeros_like(v) for k, v in p.items()}
        s = {k: np.zeros_like(v) for k, v in p.items()}
        step = 0
        while step < steps:
            order = g.permutation(len(data))
            for lo in range(0, len(order), BATCH):
                rate = 0.01 * max(0.05, 1 - step / steps)
                grad = {k: np.zeros_like(v) for k, v in p.items()}
                some = order[lo:lo + BATCH]
                for i in some:
                    codes, x, r1, rep, r2 = self._responses(data[i])
                    k1, k2 = r1.argmax(axis=0), r2.argmax(axis=0)
                    a = r1[k1, np.arange(FILTERS)] + p["conv_b"]
                    b = r2[k2, np.arange(REPEAT_FILTERS)] + p["rep_b"]
                    raw = np.concatenate([a, b])
                    h = np.maximum(raw, 0)
                    z = float(h @ p["out"] + p["out_b"][0])
                    d = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[i]
                    grad["out"] += d * h
                    grad["out_b"] += d
                    dh = (d * p["out"]) * (raw > 0)
                    d1, d2 = dh[:FILTERS], dh[FILTERS:]
                    grad["conv_b"] += d1
                    grad["rep_b"] += d2
                    grad["conv"] += x[k1].T * d1
                    grad["rep"] += rep[k2].T * d2
                    np.add.at(grad["embed"], codes[k1].ravel(), (p["conv"] * d1).T.reshape(-1, EMBED))
                step += 1
                for k in p:
                    q = grad[k] / len(some) + 1e-4 * p[k]
                    m[k] = 0.9 * m[k] + 0.1 * q
                    s[k] = 0.999 * s[k] + 0.001 * q * q
                    p[k] -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        return self


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id's text modulo FOLDS; NULL for a NULL id."""
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, max_bytes: int = TRAIN_BYTES,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> ByteConvNet:
    """Fit on at most ``rows`` labelled rows outside the held-out fold, the
    ones whose ids hash lowest, with texts of at most ``max_bytes`` bytes.

    Ids with contradicting labels and NULL labels teach nothing; without rows
    of both classes the untrained network is returned with a constant score.
    Only the chosen rows come to the driver: at most rows * max_bytes bytes.
    """
    known = labels.where(F.col(label_col).isNotNull() & (fold(id_col) != HELD_OUT)).groupBy(
        F.col(f"`{id_col}`").alias("_id")).agg(F.min(label_col).alias("_lo"), F.max(label_col).alias("_hi")).where(
        "_lo = _hi").select("_id", F.col("_lo").alias("_label"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(rows)
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), utf8(text_col).alias("_utf8")).where(
        F.octet_length("_utf8") <= max_bytes)
    got = sorted(((r["_id"], bytes(r["_utf8"]), r["_label"]) for r in
                  texts.join(F.broadcast(chosen), "_id").dropDuplicates(["_id"]).collect()))   # at most ``rows`` ids
    net = ByteConvNet()
    if len({y for _, _, y in got}) < 2:
        net.p["out"][:] = 0
        return net
    return net.fit([t for _, t, _ in got], [y for _, _, y in got])


def score_documents(docs: DataFrame, net: ByteConvNet, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, score (0 to 1) of the whole text; the text alone is
    the input.  NULL and empty texts are scored as one chunk of padding;
    repeated rows get equal scores; further columns are ignored; no shuffle."""
    weights = docs.sparkSession.sparkContext.broadcast(net.p)   # a few kB, fixed by the network's shape

    def run(batches):
        model = ByteConvNet()
        model.p = weights.value
        for batch in batches:
            scores = [model.score(np.frombuffer(t.as_py(), np.uint8)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=[id_col, "score"])

    return docs.select(f"`{id_col}`", utf8(text_col).alias("_utf8")).mapInArrow(
        run, f"`{id_col}` {id_type(docs, id_col)}, score double")


def score_column(net: ByteConvNet, spark, text_col: str = "text") -> Column:
    """The score as a column, for filters that keep all other columns."""
    weights = spark.sparkContext.broadcast(net.p)

    @F.pandas_udf("double")
    def score(texts):
        model = ByteConvNet()
        model.p = weights.value
        return texts.map(lambda t: model.score(np.frombuffer(t, np.uint8)))

    return score(utf8(text_col))
