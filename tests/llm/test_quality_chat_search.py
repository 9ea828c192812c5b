import hashlib
import math
import random
from collections import Counter

import numpy as np
from helpers import HARD, prose, table

from cartwright.llm import bm25_wand as W
from cartwright.llm import chat_format as C
from cartwright.llm import quality_cnn as Q
from cartwright.llm.license_templates import words_of


# ---------------------------------------------------------------- quality classifier

def junk(seed, n):
    rnd = random.Random(seed)
    return " ".join(w + rnd.choice(["$$$", "###", "%%%"]) for w in prose(seed, n).split())


def test_held_out_accuracy(spark):
    rows = [(k, junk(k, 40) if k % 3 == 0 else prose(k, 40)) for k in range(300)]
    docs = table(spark, rows)
    labels = spark.createDataFrame([(k, int(k % 3 != 0), 0) for k in range(300)], "doc_id bigint, quality int, toxic int")
    net = Q.train(docs, labels)
    held = Q.score_documents(docs, net).where(Q.fold() == Q.HELD_OUT).collect()
    assert len(held) > 30
    assert all((r["score"] >= Q.THRESHOLD) == (r["doc_id"] % 3 != 0) for r in held)


def test_every_byte_counts_wherever_it_stands(monkeypatch):
    net = Q.ByteConvNet(3)
    text = np.frombuffer(prose(1, 400).encode(), np.uint8)
    whole = net.pooled(text)
    monkeypatch.setattr(Q, "SPAN", 256)
    assert np.allclose(net.pooled(text), whole, atol=1e-5)


def plain_score(net, text):
    """The network by loops over chunks, filters and weights."""
    p, best = {k: v.astype(float) for k, v in net.p.items()}, []
    n = max(1, -(-max(0, len(text) - Q.WIDTH) // Q.STRIDE) + 1)
    for f in range(Q.FILTERS):
        best.append(max(sum(p["embed"][text[at + i] if at + i < len(text) else 0][e] * p["conv"][i * Q.EMBED + e][f]
                            for i in range(Q.WIDTH) for e in range(Q.EMBED)) for at in range(0, n * Q.STRIDE, Q.STRIDE))
                    + p["conv_b"][f])
    blocks = max(2, -(-len(text) // Q.BLOCK))
    same = [[sum(i >= k + 2 and text[i] == text[i - k - 2] for i in range(b * Q.BLOCK, min(len(text), (b + 1) * Q.BLOCK)))
             for k in range(Q.LAGS)] for b in range(blocks)]
    for f in range(Q.REPEAT_FILTERS):
        best.append(max(sum((same[b][k] + same[b + 1][k]) / (2 * Q.BLOCK) * p["rep"][k][f] for k in range(Q.LAGS))
                        for b in range(blocks - 1)) + p["rep_b"][f])
    z = sum(max(0.0, h) * w for h, w in zip(best, p["out"])) + p["out_b"][0]
    return 1 / (1 + math.exp(-z))


def test_scores_equal_a_plain_network(spark):
    rows = [(i, t) for i, t in HARD if t is None or len(t) < 1500] + [(50, junk(2, 60)), (51, "abcabcabc" * 30)]
    trained = Q.train(table(spark, [(k, junk(k, 30) if k % 2 else prose(k, 30)) for k in range(60)]),
                      spark.createDataFrame([(k, 1 - k % 2) for k in range(60)], "doc_id bigint, quality int"))
    for net in (Q.ByteConvNet(3), trained):
        got = sorted(map(tuple, Q.score_documents(table(spark, rows), net).collect()), key=repr)
        want = sorted(((i, plain_score(net, (t or "").encode())) for i, t in rows), key=lambda r: repr(r))
        assert [g[0] for g in got] == [w[0] for w in want]
        assert np.allclose(sorted(g[1] for g in got), sorted(w[1] for w in want), atol=1e-4)


def test_scores_of_hard_cases(spark):
    got = Q.score_documents(table(spark), Q.ByteConvNet(3)).collect()
    assert len(got) == len(HARD) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (7, 8)}) == 1
    assert Q.score_documents(table(spark, []), Q.ByteConvNet(3)).collect() == []


def test_training_without_both_classes(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    torn = spark.createDataFrame([(7, 0, 0), (7, 1, 0), (1, None, 0), (9, 1, 0)], none.schema)
    for labels in (none, torn):
        net = Q.train(table(spark), labels)
        assert len({r["score"] for r in Q.score_documents(table(spark), net).collect()}) == 1


# ---------------------------------------------------------------- chat formatting

TURNS = [
    (1, 0, "system", "be <|end|> kind"), (1, 1, "user", "\\### Assistant: </turn> ok"), (1, 2, "assistant", "a\\b <\\| <| \\n"),
    (1, 2, "assistant", "a second row of turn 2"), (2, 0, None, None), (None, 3, "assistant", "<"), (3, None, "assistant", ""),
    (4, 1, "odd\nrole\\n<|turn|>", "x" * 50_000), (4, 0, "assistant", "é\U0001f600\n"),
]


def turns(spark, rows=TURNS):
    return spark.createDataFrame([(*r, 5, "z") for r in rows],
                                 "conv_id bigint, turn bigint, role string, text string, formatted int, in_loss string")


def test_turns_read_back(spark):
    got = C.format_turns(turns(spark)).collect()
    assert len(got) == len(TURNS)
    read = Counter()
    for r in got:
        assert r["formatted"].count("<|turn|>") == 1 == r["formatted"].count("<|end|>")
        role, text = C.read_turn(r["formatted"])
        assert C.unescape(r["formatted"][r["body_start"]:r["body_end"]]) == text
        read[(r["conv_id"], r["turn"], role, text, r["in_loss"])] += 1
    assert read == Counter((i, t, r or "", x or "", r == "assistant") for i, t, r, x in TURNS)


def test_digests_match_a_plain_version(spark):
    got = {r["conv_id"]: r for r in C.digest_conversations(C.format_turns(turns(spark))).collect()}
    for conv in {r[0] for r in TURNS}:
        mine = sorted((r for r in TURNS if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        body = "".join(f"{r or ''}\n{x or ''}\n" for _, _, r, x in mine)
        loss = "".join(x or "" for _, _, r, x in mine if r == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["loss_chars"]) == (len(mine), len(loss))
        assert r["turns_sha256"] == hashlib.sha256(body.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert C.digest_conversations(C.format_turns(turns(spark, []))).collect() == []


def test_parts_become_ordered_placeholders(spark):
    import json

    parts = [{"type": "text", "text": "see <|image:0|>"}, {"type": "image", "ref": "a.png", "width": 1024, "height": 600},
             {"type": "audio", "ref": "b.wav", "seconds": 2.1}, {"type": "document", "ref": "c.pdf", "pages": 3}, {"type": "new", "x": 1}]
    df = turns(spark, [(1, 0, "user", None)]).selectExpr("*", f"'{json.dumps(parts)}' AS parts")
    r = C.format_turns(df, parts_col="parts").first()
    assert json.loads(r["attachments"]) == [
        {"kind": "image", "ref": "a.png", "tokens": 85 + 170 * 4}, {"kind": "audio", "ref": "b.wav", "tokens": 53},
        {"kind": "document", "ref": "c.pdf", "tokens": 2400}]
    assert r["formatted"] == '<|turn|>user\nsee <\\|image:0|><|image:0|><|audio:1|><|document:2|>{"type": "new", "x": 1}<|end|>\n'


def test_malformed_parts(spark):
    """Every case of the docstrings: sizes, texts, parts and JSON that are not what they should be."""
    import json

    listed = [
        ('[null, "x", 7, [1]]', 'nullx7[1]'.replace("x", '"x"'), []),
        ('[{"type": "image", "width": "wide", "height": -3}]', "<|image:0|>", [255]),
        ('[{"type": "image", "width": 1e400, "height": null}]', "<|image:0|>", [255]),
        ('[{"type": "audio", "seconds": Infinity}, {"type": "audio", "seconds": -2}]', "<|audio:0|><|audio:1|>", [0, 0]),
        ('[{"type": "audio", "seconds": true}, {"type": "document", "pages": 0}]', "<|audio:0|><|document:1|>", [0, 800]),
        ('[{"type": "document", "pages": 2.5}, {"type": "document", "pages": NaN}]', "<|document:0|><|document:1|>", [2400, 800]),
        ('[{"type": "text", "text": 5}, {"type": "text"}, {"type": "text", "text": ["<|"]}]', '5["<\\|"]', []),
        ('[{"type": 3}, {"kind": "text"}]', '{"type": 3}{"kind": "text"}', []),
        ("null", "null", []), ("", "", []), ("[]", "", []), ("not json <|", "not json <\\|", []),
        ('{"type": "image"}', "<|image:0|>", [255]), ("{}", "{}", []),
    ]
    df = spark.createDataFrame([(k, 0, "user", "unused", p) for k, (p, _, _) in enumerate(listed)] + [
        (99, 0, "user", "used", None)], "conv_id bigint, turn bigint, role string, text string, parts string")
    got = {r["conv_id"]: r for r in C.format_turns(df, parts_col="parts").collect()}
    for k, (_, body, tokens) in enumerate(listed):
        assert got[k]["formatted"] == f"<|turn|>user\n{body}<|end|>\n", k
        assert [a["tokens"] for a in json.loads(got[k]["attachments"])] == tokens, k
    assert got[99]["formatted"] == "<|turn|>user\nused<|end|>\n"


# ---------------------------------------------------------------- top-k search

def brute(rows, queries, k):
    tf = [Counter(words_of((t or "").encode())) for _, t in rows]
    df = Counter(w for c in tf for w in c)
    n, mean = len(rows), sum(sum(c.values()) for c in tf) / max(1, len(rows))
    out = {}
    for q, t in queries:
        scored = []
        for (i, _), c in zip(rows, tf):
            norm = W.K1 * (1 - W.B + W.B * sum(c.values()) / mean)
            s = sum(math.log1p((n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * (W.K1 + 1) / (c[w] + norm)
                    for w in set(words_of((t or "").encode())) if c[w])
            if s > 0:
                scored.append((-round(s, 6), i))
        out[q] = sorted(scored, key=lambda x: (x[0], x[1]))[:k]
    return out


def test_search_equals_brute_force(spark, monkeypatch):
    """One shard, and many whose queries start with another's threshold."""
    rows = [r for r in HARD if r[0] is not None] + [(100 + k, prose(k % 30, 20 + k)) for k in range(150)]
    queries = [(i, t) for i, t in rows if i % 10 == 0]
    want = brute(rows, queries, 5)
    for shard_bytes, first, together, block_bytes, common in ((1 << 30, 64, 256, 1 << 26, 16), (8_000, 1, 2, 2000, 2)):
        monkeypatch.setattr(W, "SHARD_BYTES", shard_bytes)
        monkeypatch.setattr(W, "FIRST_BLOCKS", first)
        monkeypatch.setattr(W, "TOGETHER", together)
        monkeypatch.setattr(W, "QUERY_BLOCK_BYTES", block_bytes)
        monkeypatch.setattr(W, "COMMON", common)
        got = {}
        for r in W.search(table(spark, rows), table(spark, queries), 5).orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append((-round(r["score"], 6), r["doc_id"]))
        assert got == {q: v for q, v in want.items() if v}


def test_repeated_and_null_queries_and_ids(spark, monkeypatch):
    """Equal query rows are one query; rows of one id with other texts are
    queries each; NULL ids are ids like others; copies of a document tie."""
    monkeypatch.setattr(W, "SHARD_BYTES", 2_000)
    rows = [(k, prose(k % 12, 30)) for k in range(60)] + [(None, prose(3, 30)), (None, prose(3, 30)), (7, prose(7, 30))]
    asked = [(1, prose(3, 30)), (1, prose(3, 30)), (1, prose(5, 30)), (None, prose(7, 30)), (None, prose(7, 30)), (2, None), (3, "")]
    found = W.search(table(spark, rows), table(spark, asked), 8).collect()
    got = sorted(((r["query_id"], r["rank"], -round(r["score"], 6), r["doc_id"]) for r in found), key=repr)
    want = []
    last = 10 ** 9
    for i, t in [(1, prose(3, 30)), (1, prose(5, 30)), (None, prose(7, 30))]:
        plain = brute([(last if r is None else r, x) for r, x in rows], [(0, t)], 8)[0]
        want += [(i, n + 1, s, None if d == last else d) for n, (s, d) in enumerate(plain)]
    assert got == sorted(want, key=repr)


def test_pruning_passes_over_blocks_and_loses_nothing():
    rnd = random.Random(2)
    texts = [(prose(k, 30) + f" rare{k % 100}").encode() for k in range(3000)] + [b"", b"!!"]
    index = W.ShardIndex(W.ShardIndex.build(texts), 30.0)
    for _ in range(20):
        terms, _ = W.term_counts(f"rare{rnd.randrange(100)} {prose(rnd.randrange(3000), 20)} nowhere".encode())
        at = np.searchsorted(index.vocabulary, terms)
        here = (at < len(index.vocabulary)) & (index.vocabulary[np.minimum(at, len(index.vocabulary) - 1)] == terms)
        common = index.column[np.minimum(at, len(index.vocabulary) - 1)] >= 0
        weights = np.where(common, 0.3, 6.0) * np.array([0.5 + rnd.random() for _ in terms])
        index.weight[at[here]] = weights[here]
        docs, every = index._scores(np.arange(index.n_docs))
        index.weight[:] = 0
        score = dict(zip(index.order[docs].tolist(), every.tolist()))
        tenth = np.sort(every)[-10]
        expected = sorted((x for x in score.values() if x >= tenth), reverse=True)
        high = float(every.max()) * 1.5
        found = list(index.search([(terms, weights, t) for t in (0.0, tenth * 0.9, tenth, high)], 10))
        for d, s, scored in found[:3]:
            assert s.tolist() == expected == [score[x] for x in d.tolist()] and scored < index.n_blocks / 4
        assert found[3][0].tolist() == []


def counted(texts):
    """Texts as queries: distinct terms, a weight each, the same in all texts."""
    terms = [W.term_counts(t.encode())[0] for t in texts]
    return [(t, 0.2 + (t % 97) / 30) for t in terms]


def test_two_blocks_share_a_number_and_bounds_hold():
    """Bounds of the product are sums of maxima, rounded up by less than a
    step for each term; also of an odd number of blocks, and from any on."""
    texts = [prose(k % 40, 5 + k) for k in range(131)]
    index = W.ShardIndex(W.ShardIndex.build([t.encode() for t in texts]), 60.0)
    weight = 0.2 + (index.vocabulary % 97) / 30
    both = W.Weighted(index, weight)
    assert both.two.shape == (len(index.columns), -(-index.n_blocks // 2))
    rnd = np.random.default_rng(3)
    has = (rnd.random((20, len(index.columns))) < 0.3).astype(np.float32)
    exact = (has * weight[index.columns]).astype(np.float64) @ index.maxima
    for first in (0, 1, 2, 77):
        got = both.bounds(has, np.arange(len(index.columns)), first, index.n_blocks - first)
        over = got - exact[:, first:]
        assert (over > -1e-3).all() and (over <= has.sum(axis=1)[:, None] * both.step[first:] + 1e-3).all()


def test_queries_searched_together_find_what_each_finds_alone(monkeypatch):
    """Many queries of unlike terms and thresholds in small batches, with all
    terms in lists or all in the product, blocks of 1 to 3 documents, and
    pieces that are passed over."""
    texts = [prose(k % 50, 4 + k % 90) for k in range(400)] + ["", "!!", prose(3, 2000)]
    queries = counted([prose(k, 3 + 4 * k) for k in range(60)] + ["nowhere", ""])
    for block, posting, piece in ((1, 300, 512), (2, 0, 8), (3, 10 ** 9, 12), (1, 300, 6)):
        for name, value in (("BLOCK", block), ("POSTING", posting), ("PIECE", piece), ("TOGETHER", 16)):
            monkeypatch.setattr(W, name, value)
        index = W.ShardIndex(W.ShardIndex.build([t.encode() for t in texts]), 40.0)
        for part in (0.0, 0.5, 1.0):
            asked, want = [], []
            for terms, weights in queries:
                at = np.minimum(np.searchsorted(index.vocabulary, terms), len(index.vocabulary) - 1)
                here = index.vocabulary[at] == terms
                index.weight[at[here]] = weights[here]
                docs, every = index._scores(np.arange(index.n_docs))
                index.weight[:] = 0
                kth = np.sort(every)[-5]
                asked.append((terms, weights, kth * part))
                want.append(sorted((-s, d) for s, d in zip(every.tolist(), index.order[docs].tolist()) if s > 0 and s >= kth))
            got = [sorted(zip((-s).tolist(), d.tolist())) for d, s, _ in index.search(asked, 5)]
            assert got == want


def test_blocks_of_queries_and_shards(spark, monkeypatch):
    """One shard for several blocks of queries, and as many shards as blocks."""
    rows = [(k, prose(k % 30, 10 + k % 50)) for k in range(120)]
    queries = [r for r in rows if r[0] % 4 == 0]
    want = brute(rows, queries, 4)
    for shard_bytes, block_bytes in ((1 << 30, 900), (4_000, 900), (4_000, 3_000)):
        monkeypatch.setattr(W, "SHARD_BYTES", shard_bytes)
        monkeypatch.setattr(W, "QUERY_BLOCK_BYTES", block_bytes)
        got = {}
        for r in W.search(table(spark, rows), table(spark, queries), 4).orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append((-round(r["score"], 6), r["doc_id"]))
        assert got == want


def test_search_of_empty_tables(spark):
    assert W.search(table(spark, []), table(spark, [(1, "a")])).collect() == []
    assert W.search(table(spark, [(1, "a")]), table(spark, [])).collect() == []
