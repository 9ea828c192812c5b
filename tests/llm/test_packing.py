import numpy as np
import public_tokenizers
from helpers import HARD, prose, table
from tokenizers import Tokenizer

from cartwright.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")


def reference():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [2]


def test_pieces_rebuild_every_document_and_fill_every_window(spark):
    rows = [(i, t) for i, t in enumerate(t for _, t in HARD)]      # distinct ids, so pieces can be told apart
    window = 64
    pieces = P.pack_documents(table(spark, rows).repartition(3), PATH, window).collect()
    ids_of = reference()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        ids = np.frombuffer(p["ids"], "<u4").tolist()
        assert len(ids) == p["length"] > 0
        by_doc.setdefault(p["doc_id"], []).append((p["start"], ids, p["doc_tokens"], p["continues"]))
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for i, text in rows:
        parts = sorted(by_doc[i])
        assert sum((ids for _, ids, _, _ in parts), []) == ids_of(text)
        assert [s for s, *_ in parts] == list(np.cumsum([0] + [len(x) for _, x, _, _ in parts])[:-1])
        assert [c for *_, c in parts] == [True] * (len(parts) - 1) + [False]
        assert {n for _, _, n, _ in parts} == {len(ids_of(text))}
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for k, parts in by_sequence.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == window or (k == len(by_sequence) - 1 and at <= window)


def test_repeated_rows_are_packed_each(spark):
    got = P.pack_documents(table(spark, [(1, "a b"), (1, "a b"), (None, None)]), PATH, 4096).collect()
    assert sorted((p["doc_id"] or 0, p["length"]) for p in got) == [(0, 1), (1, 3), (1, 3)]


def test_empty_table(spark):
    assert P.pack_documents(table(spark, []), PATH).collect() == []


def test_word_memo_equals_the_tokenizer():
    ids_of, words = reference(), P.WordTokens(PATH)
    texts = [t or "" for _, t in HARD] + ["it's we'll they'VE 'sour 12 3a a3 co-op e.g. <|endoftext|>", "ﬁ Å Ǆ \x1c\x85 x",
                                          "ÀÉÎÕÜ àéîõü ſt Ÿ ÿ", prose(3, 2000)]
    for _ in range(2):       # the second time from the memo
        for got, text in zip(words.encode(texts), texts):
            assert np.frombuffer(got, words.dtype).tolist() == ids_of(text)[:-1]


def test_special_tokens_are_what_the_tokenizer_makes_of_them(spark):
    """As it is loaded: their strings in a text are their ids."""
    ids_of = reference()
    texts = ["a <|endoftext|> b", "<|startoftext|>x<|ENDOFTEXT|>", "plain <| endoftext |>"]
    assert len(ids_of(texts[0])) == 4
    got = {p["doc_id"]: np.frombuffer(p["ids"], "<u4").tolist()
           for p in P.pack_documents(table(spark, list(enumerate(texts))), PATH).collect()}
    assert got == {k: ids_of(t) for k, t in enumerate(texts)}


def test_ids_of_a_wide_vocabulary_keep_their_width(spark, monkeypatch, tmp_path):
    """A tokenizer that splits otherwise, with more than 65,536 ids: the memo
    of words is left aside and ids stay whole."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    vocab = {f"w{k}": k for k in range(70_000)} | {"<unk>": 70_000}
    wide = Tokenizer(models.WordLevel(vocab, unk_token="<unk>"))
    wide.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    path = str(tmp_path / "wide.json")
    wide.save(path)
    assert not P.WordTokens(path).by_word and P.WordTokens(PATH).by_word
    rows = [(1, "w69999 w3 w65536"), (2, None), (3, "W3 w7's")]
    got = {}
    for p in P.pack_documents(table(spark, rows), path, window=2).orderBy("doc_id", "start").collect():
        got.setdefault(p["doc_id"], []).extend(np.frombuffer(p["ids"], "<u4").tolist())
    assert got == {i: wide.encode(t or "").ids + [2] for i, t in rows}


def test_forgotten_words_are_put_together_from_known_parts(monkeypatch):
    """Parts stay when the memo of words is full: no part is tokenised twice."""
    ids_of, words, learned = reference(), P.WordTokens(PATH), []
    monkeypatch.setattr(P, "MEMO_WORDS", 300)
    monkeypatch.setattr(P, "RUN", 7)
    learn = words._learn
    monkeypatch.setattr(words, "_learn", lambda parts: (learned.extend(parts), learn(parts)))
    stems = ["alpha", "beta", "über", "groß", "ſtadt", "łódź", "x", "naïve"]
    for k in range(40):
        texts = [f"{a}{k}{b}, {b}'s" for a in stems for b in stems] + ["", "日本 x", " "]
        for got, text in zip(words.encode(texts), texts):
            assert np.frombuffer(got, words.dtype).tolist() == ids_of(text)[:-1]
    assert len(words.memo) < 600
    assert len(learned) == len(set(learned))
