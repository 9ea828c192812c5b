"""Token alignment against token-by-token loops."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from helpers import HARD, collected, prose, table

from cartwright.llm import token_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [(30, "<|endoftext|> <s> </s> <unk> <0x41>"), (31, "a▁b"), (32, "x\x00y\x01"), (33, "ﬁ ① ½"),
       (34, "  lead and   trail  "), (35, "é́ é"), (36, "tab\tnew\r\nline"), (37, "\U0001f468‍\U0001f469‍\U0001f467"),
       (38, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 20), (39, "日本語" * 50)]


def spans(ids, size):
    out, at = [], 0
    for i in ids:
        out.append((i, at, at + size[i]))
        at += size[i]
    return out


def plain(rows):
    """Tokens from the libraries, groups and links by loops over spans."""
    import sentencepiece
    from tokenizers import Tokenizer

    pair = token_alignment.load_pair(A, B)
    tok, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    docs, count = [], Counter()
    for i, text in rows:
        a = tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if b"".join(pair.bytes_a[x] for x in a) != whole or b"".join(pair.bytes_b[x] for x in b) != whole:
            a, b = [], []
        sa, sb = spans(a, pair.size_a), spans(b, pair.size_b)
        links = [(x, y) for x, s, e in sa for y, t, f in sb if s < f and t < e]
        ends = sorted({e for *_, e in sa} & {e for *_, e in sb})
        groups = [(",".join(str(x) for x, s, e in sa if lo < e <= hi), ",".join(str(x) for x, s, e in sb if lo < e <= hi))
                  for lo, hi in zip([0, *ends], ends)]
        count.update(links)
        digest = hashlib.sha256(";".join("|".join(g) for g in groups).encode()).hexdigest() if a else ""
        docs.append((i, len(a), len(b), len(groups), links, digest))
    most = defaultdict(int)
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return sorted(((i, na, nb, ng, len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links), d)
                   for i, na, nb, ng, links, d in docs), key=repr)


def test_rows_equal_plain_loops(spark, monkeypatch):
    rows = [(i, t) for i, t in HARD if t is None or len(t) < 10_000] + ODD
    expected = plain(rows)
    assert collected(token_alignment.align_documents(table(spark, rows), A, B)) == expected
    assert sum(r[1] > 0 for r in expected) > 15 and any(r[1] == 0 and r[0] == 31 for r in expected)


def test_words_are_tokenised_as_in_the_whole_text():
    """The memo of words against the libraries on whole texts."""
    pair = token_alignment.Pair(A, B)
    texts = [t for _, t in [*HARD, *ODD] if t] + [prose(5, 500) + "\n\n x  y\t z. 'll it's \u00a0 \u3000 a\x1c b\x85 c ▁ d"]
    for _ in range(2):      # learned, and remembered
        for text, (a, b) in zip(texts, pair.tokens([t.encode() for t in texts])):
            if len(a):
                assert a.tolist() == pair.a.encode(" " + text, add_special_tokens=False).ids
                assert b.tolist() == pair.b.encode(text)
    assert pair.apart and max(map(len, pair.ids_a)) <= token_alignment.MEMO_LENGTH


def test_chunks_do_not_change_rows(monkeypatch):
    """Texts one by one and together; a memo that overflows."""
    pair = token_alignment.Pair(A, B)
    raws = [prose(k, 300).encode() for k in range(5)] + ["日本 語 ".encode() * 40]
    whole = pair.tokens(raws)
    monkeypatch.setattr(token_alignment, "MEMO_WORDS", 20)
    for (a, b), raw in zip(whole, raws):
        (c, d), = pair.tokens([raw])
        assert (a == c).all() and (b == d).all()
    together = token_alignment.align(pair, whole)
    monkeypatch.setattr(token_alignment, "HASHED", 7)
    apart = [token_alignment.align(pair, [t]) for t in whole]
    for k in range(5):
        assert list(together[k]) == [x for one in apart for x in one[k]]
    assert (together[5] == np.concatenate([one[5] for one in apart])).all()


def test_division_finds_every_shared_cut(monkeypatch):
    """Random cuts; dense, sparse and none shared; with few looks in turn the
    rest of an interval is looked up at once."""
    rnd = random.Random(7)
    for leaps in (16, 1):
        monkeypatch.setattr(token_alignment, "LEAPS", leaps)
        for share in (0.9, 0.1, 0.0):
            n = 3000
            stops = [700, 701, 2000, n]
            a = {x for x in range(1, n) if rnd.random() < 0.5}
            b = {x for x in range(1, n) if x not in a or rnd.random() < share} if share else set(range(1, n)) - a
            a, b = (np.array(sorted(x | set(stops))) for x in (a, b))
            cut_a, cut_b = token_alignment.shared_cuts(a, b, np.searchsorted(a, stops), np.searchsorted(b, stops))
            assert a[cut_a].tolist() == b[cut_b].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_empty_table_and_text_ids(spark):
    assert token_alignment.align_documents(table(spark, []), A, B).count() == 0
    docs = spark.createDataFrame([("x", "one text"), (None, None), ("x", "one text")], "doc_id string, text string")
    got = collected(token_alignment.align_documents(docs, A, B))
    assert got[2] == (None, 0, 0, 0, 0, 0, 0, "") and got[0] == got[1] and got[0][6] == 2 * got[0][4]


def test_places_travel_small_and_come_back():
    """Two bytes a place and less, four where there are more pairs than two tell apart."""
    rnd = np.random.default_rng(5)
    for n, most in ((1, 2), (9000, 2), (1 << 16, 2), ((1 << 16) + 1, 4)):
        places = np.append(rnd.integers(0, n, 100_000), n - 1)
        packed = token_alignment.pack_places(places, n)
        assert packed[0] == most and len(packed) < most * len(places) * 1.01
        assert (token_alignment.unpack_places(packed, len(places)) == places).all()


def test_counting_keeps_no_tokenizers():
    """A worker that aligned texts before lets go of the models and the memo."""
    import pyarrow as pa

    token_alignment.load_pair(A, B)
    assert list(token_alignment._counted(pa.int64(), "doc_id")(iter([]))) == []
    assert token_alignment.load_pair.cache_info().currsize == 0
