import base64
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import HARD, table

from cartwright.llm import bpe_monoid as B

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def plain():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return enc.encode_ordinary


@pytest.fixture(scope="module")
def codec():
    return B.load_codec(PATH, PATTERN, True)


def texts():
    rnd = random.Random(3)
    parts = ["a", "b", "aa", "ab", "th", "the", "é", " ", "  ", "\n", "\t", "ß", "ation", "'s", "1", "23", "日", "!", " "]
    some = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(80))) for _ in range(400)]
    glued = ["".join(rnd.choice("abcdefgh") for _ in range(n)) for n in (33, 500, 4000)]
    return some + glued + ["a" * 3000, "ab" * 2000, "!" * 999, " " * 999, "", "x \n y", "x  \n", " x", "x "] + [t or "" for _, t in HARD]


def test_texts_encode_as_the_library_does(plain, codec, monkeypatch):
    """One by one and together, learned and remembered, with a memo that
    overflows, and with stretches from space to space or without."""
    expected = [plain(t) for t in texts()]
    for own, overflow in ((codec, 250_000), (B.TextCodec(PATH, PATTERN, True), 0), (B.TextCodec(PATH, PATTERN, False), 10)):
        monkeypatch.setattr(B, "MEMO_WORDS", overflow)
        for _ in range(2):
            for t, want, ids in zip(texts(), expected, own.encode_all(texts())):
                assert np.frombuffer(ids, "<u4").tolist() == want == np.frombuffer(own.encode(t), "<u4").tolist()
                assert own.decode(ids) == t.encode()


def test_other_patterns_are_not_cut_at_spaces():
    pattern = r"[a-z ]+|\s+|."
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    own = B.TextCodec(PATH, pattern, False)
    for t in ["the end of the line", " a b  c ", "x" * 50 + " and more of it", *texts()[:40]]:
        if "\n" not in t:      # the dot leaves line ends out
            assert np.frombuffer(own.encode(t), "<u4").tolist() == enc.encode_ordinary(t)


def test_what_is_no_token_passes_the_tree(codec):
    """Each match that is no token is joined from its bytes: one join fewer
    than it has bytes, most of them at seams that are not stable."""
    own = B.TextCodec(PATH, PATTERN, True)
    words = {w for t in texts() for w in re.findall("[a-z]+", t) if w.encode() not in own.bpe.ranks}
    data = [w.encode() for w in sorted(words)]
    ids, count = own.bpe.tree(data)
    assert own.bpe.joins == sum(map(len, data)) - len(data) and own.bpe.joins > own.bpe.unstable > 0
    at = 0
    for d, n in zip(data, count.tolist()):
        assert ids[at:at + n].tolist() == own.bpe.merge(d)
        at += n
    assert own.bpe.tree([])[0].tolist() == []


@pytest.mark.parametrize("ordered", [True, False])
def test_stable_pairs_are_those_that_encode_to_themselves(codec, ordered):
    rnd = random.Random(11)
    bpe = B.TextCodec(PATH, PATTERN, True).bpe
    assert bpe.ordered
    bpe.ordered = ordered
    tokens = [b for b in bpe.ranks if len(b) > 1]
    pairs = [(rnd.randrange(50256), rnd.randrange(50256)) for _ in range(3000)]
    for _ in range(3000):
        w = rnd.choice(tokens) + rnd.choice(tokens)
        k = rnd.randrange(1, len(w))
        pairs.append((bpe.merge(w[:k])[-1], bpe.merge(w[k:])[0]))
    pairs += [(a, a) for a in range(0, 50256, 97)]
    got = bpe.stable(*(np.array(x) for x in zip(*pairs)))
    want = [bpe.merge(bpe.bytes_of[a] + bpe.bytes_of[b]) == [a, b] for a, b in pairs]
    assert got.tolist() == want and 0 < sum(want) < len(want)


def test_join_is_a_monoid(codec):
    rnd = random.Random(5)
    bpe = codec.bpe
    for _ in range(300):
        a, b, c = (bytes(rnd.choice(b"thesandingou") for _ in range(rnd.randrange(0, 60))) for _ in range(3))
        ea, eb, ec = map(bpe.merge, (a, b, c))
        assert bpe.join(ea, eb) == bpe.merge(a + b)
        assert bpe.join(bpe.join(ea, eb), ec) == bpe.join(ea, bpe.join(eb, ec)) == bpe.merge(a + b + c)
        assert bpe.join([], ea) == ea == bpe.join(ea, [])


def test_scan_and_heap_agree(codec):
    rnd = random.Random(6)
    for n in (1, 2, 7, 16, 40):
        data = bytes(rnd.randrange(256) for _ in range(n))
        assert codec.bpe._merge_scan(data, 1 << 62) == codec.bpe._merge_heap(data, 1 << 62)


def test_documents(spark, plain):
    got = B.digest_documents(table(spark), PATH, PATTERN).collect()
    want = []
    for i, t in HARD:
        ids = plain(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert B.digest_documents(table(spark, []), PATH, PATTERN).collect() == []


def test_round_trip_through_frames(spark):
    back = B.decode_documents(B.encode_documents(table(spark), PATH, PATTERN), PATH, PATTERN)
    got = sorted(((r["doc_id"], bytes(r["utf8"]).decode()) for r in back.collect()), key=repr)
    assert got == sorted(((i, t or "") for i, t in HARD), key=repr)
