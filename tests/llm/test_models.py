import math
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from pactlens.llm import bytenet, lm, mixnet, permindex, quality
from pactlens.llm.bpe import ChunkEncoder, cuts, encode_digests, encode_table, vocabulary_path
from pactlens.llm.dom import Page
from pactlens.llm.extract import extract, marginals, train
from pactlens.llm.lm import score_texts
from pactlens.llm.permindex import nearest

from tests.conftest import plan_of

from .conftest import ODD


def test_network_covers_the_whole_text_and_learns():
    data = bytes(range(256)) * 9
    chunks = bytenet.chunks_of(data)
    step = bytenet.CHUNK - bytenet.OVERLAP
    rebuilt = np.concatenate([chunks[0], *[c[bytenet.OVERLAP :] for c in chunks[1:]]])
    assert bytes(rebuilt[: len(data)].astype(np.uint8)) == data and (rebuilt[len(data) :] == 256).all() and step > 0
    rng = random.Random(1)
    words = ["the", "and", "house", "tree", "of", "river"]
    texts = [" ".join(rng.choice(words) + ("%%%" if i % 2 else "") for _ in range(rng.randint(5, 200))).encode() for i in range(160)]
    labels = np.array([1 - i % 2 for i in range(160)], np.float32)
    net = bytenet.ByteNet()
    net.fit([bytenet.chunks_of(t) for t in texts[:120]], labels[:120], epochs=12)
    assert ((net.score(texts[120:]) > 0.5) == labels[120:]).mean() > 0.95
    long = texts[0] * 3000
    assert net.score([long, b""]).shape == (2,)
    assert net.score([texts[0], texts[1]])[1] == pytest.approx(net.score([texts[1]])[0], abs=1e-6)


def test_gradients_of_the_network():
    net = bytenet.ByteNet(3)
    rng = random.Random(0)
    texts = [bytes(rng.choice(b"abcdefgh ,.") for _ in range(900)), bytes(rng.choice(b"xyzabc ,.") for _ in range(300))]
    docs = [bytenet.chunks_of(t) for t in texts]
    labels = np.array([1.0, 0.0], np.float32)

    def loss():
        s = net.score(texts)
        return -np.mean(labels * np.log(s) + (1 - labels) * np.log(1 - s))

    grads = net._gradients(docs, labels)
    for name in ("out", "hidden", "filters", "offset", "embed"):
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        old = net.p[name][at]
        net.p[name][at] = old + 2e-3
        up = loss()
        net.p[name][at] = old - 2e-3
        down = loss()
        net.p[name][at] = old
        assert (up - down) / 4e-3 == pytest.approx(grads[name][at], rel=0.15, abs=2e-4)


def test_quality_learns_only_from_its_folds(spark, documents):
    docs = documents(ODD)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.train(docs, none) == 1.0
    labels = spark.createDataFrame([(1, 0, 0), (5, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.train(docs, labels) in (0.0, 1.0)
    scored = quality.scores(docs, bytenet.ByteNet()).collect()
    assert len(scored) == len(ODD) and all(0 <= r["score"] <= 1 for r in scored)
    assert quality.drop_rejected(docs, 1.0).columns == docs.columns
    assert quality.drop_rejected(docs, 0.1).count() == 0
    held = {r["doc_id"]: r["h"] for r in docs.select("doc_id", quality.held_out(docs["doc_id"]).alias("h")).collect()}
    assert all(h == (i is not None and zlib.crc32(str(i).encode()) % 5 == 0) for i, h in held.items())


def test_encoder_equals_the_library(spark, documents):
    rng = random.Random(2)
    alphabet = [*"ab e's'tI  \t\n\x0b\x1c\x85\xa0 éÉ=<ΣσİI1２‍中文字̸́", "<|endoftext|>", "<|startoftext|>", "'re", "'ll", " "]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 300))) for _ in range(400)]
    texts += ["x" * 9000, "中" * 5000, "", " ", "\n\n", "a " * 5000]
    encoder = ChunkEncoder(vocabulary_path())
    library = encoder.tokenizer
    for text, pair in zip(texts, encoder.encode_all(texts)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert pair == (np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False).encode())
        data = text.encode()
        assert not data or (cuts(data)[-1] == len(data) and all(data[c : c + 1].decode("utf-8", "ignore") or data[c] >= 0xC0 for c in cuts(data)[:-1]))
    docs = documents([(i, t, "s") for i, t in enumerate(texts[:20])] + ODD)
    table = {(r["id"], r["decoded"]): r for r in encode_table(docs).collect()}
    assert len(encode_digests(docs).collect()) == 20 + len(ODD)
    assert all(len(r["ids"]) == r["n_tokens"] for r in table.values())
    assert encode_digests(documents([])).count() == 0


def test_shared_passages_share_chunks():
    encoder = ChunkEncoder(vocabulary_path())
    passage = " ".join(f"word{i}" for i in range(6000))
    encoder.encode_all(["one start " + passage])
    before = len(encoder.chunks.young)
    encoder.encode_all(["quite another beginning " + passage])
    assert before > 30 and len(encoder.chunks.young) - before <= 3


def brute_marginals(scores, above, tables):
    n, total = len(scores), np.zeros(len(scores))
    z = 0.0
    for bits in range(1 << n):
        y = [bits >> i & 1 for i in range(n)]
        w = math.exp(sum(s * v for s, v in zip(scores, y)))
        for i in range(1, n):
            w *= tables[i][y[above[i]]][y[i]]
        z += w
        total += w * np.array(y)
    return total / z


def test_messages_give_exact_marginals():
    rng = random.Random(3)
    for _ in range(40):
        n = rng.randint(1, 9)
        scores = [rng.gauss(0, 2) for _ in range(n)]
        above = [-1] + [rng.randrange(i) for i in range(1, n)]
        tables = [[[math.exp(rng.gauss(0, 1)) for _ in range(2)] for _ in range(2)] for _ in range(n)]
        odds, _, _ = marginals(scores, above, tables)
        assert np.allclose([o / (1 + o) for o in odds], brute_marginals(scores, above, tables))


def test_pages(spark):
    body = "<nav><ul><li><a>Home</a></li></ul></nav><div class=ad>Buy, now.</div><article><h1>A &amp; B</h1><p><b>First   text, here.<br>On<p>Second &copy; text.</article><footer>Foot, of it.</footer>"
    rows = [(i, f"u{i}", f"<html><head><title>t</title><script>var t='</p>';</script></head><body>{body}{i}</body>") for i in range(30)]
    rows += [(90, None, None), (91, "u", ""), (92, "u", "<p"), (None, "u", "<article><p>" + "long text, " * 20000 + "</article>"), (93, "u", "<div>" * 3000 + "deep")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text")
    got = {r["page_id"]: r["text"] for r in extract(pages, train(pages)).collect()}
    assert all(got[i] == "A & B\n\nFirst text, here. On\n\nSecond © text." for i in range(30))
    assert got[90] == got[91] == "" and len(got[None]) == 20000 * 11 - 1
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert extract(empty, train(empty)).count() == 0


def test_implied_ends():
    tags = [(n.tag, n.text, Page.__name__) for n in Page("<ul><li>a<li>b<ul><li>c</ul></ul><p>d<div>e</div>f<hr>g<table><tr><td>h<td>i<tr><td>j</table>").nodes if n.tag == "#text"]
    assert [t for _, t, _ in tags] == list("abcdefghij")


@pytest.mark.parametrize(
    ("html", "seen"),
    [
        ("<html><head><title>x</title><meta name=a><body><p>a<p>b</html>", "ab"),
        ("<head><title>x</title><script>y</script><link rel=z><div>a</div>b", "ab"),
        ("<head><title>x</title>\n a<p>b", "ab"),
        ("<head><title>x</title></head><body>a<p>b", "ab"),
        ("a<form><select><option>A<option>B</select></form><p>b", "ab"),
        ("a<select><optgroup><option>A<optgroup><option>B<option>C</option></select><p>b", "ab"),
        ("a<button><svg><title>x</button><p>b", "ab"),
        ("a</option></head><div><option>x</div><p>b", "ab"),
        ("a<svg><title>x</title>y<svg></svg>z</svg><p>b", "ab"),
    ],
)
def test_hidden_elements_end(html, seen):
    assert "".join(n.text for n in Page(html).nodes if n.tag == "#text") == seen


def test_bits_are_a_distribution():
    counts = np.random.default_rng(0).integers(0, 9, (mixnet.ORDERS, 2 << mixnet.SLOT_BITS)).astype(np.uint32)
    mixer = mixnet.Mixer(mixnet.tables(counts), mixnet.first_weights())
    total = 0.0
    for byte in range(256):
        _, begins, x, gate = mixer.inputs([(b"the wor" + bytes([byte]), 4)])
        total += math.exp(mixer._bytes(mixer.weights.copy(), len(begins) - 2, len(begins) - 1, begins, x, gate)[0])
    assert total == pytest.approx(1, abs=1e-4)


def test_repeated_contexts_are_looked_up_once(monkeypatch):
    rng = random.Random(8)
    texts = [mixnet.stream([b"w%d" % (rng.randint(0, 40) ** 2) for _ in range(rng.randint(0, 400))]) for _ in range(60)]
    want = np.zeros((mixnet.ORDERS, 2 << mixnet.SLOT_BITS), np.uint32)
    raw, _, hashes = mixnet.contexts([(t, 0) for t in texts])
    sizes, _, nodes, bits = mixnet.decisions(raw)
    for o in range(mixnet.ORDERS):
        at = mixnet.slots(hashes[o], sizes, nodes).astype(np.int64)
        want[o] = np.bincount(2 * at + bits, minlength=want.shape[1])
    asked, slots = [], mixnet.slots
    monkeypatch.setattr(mixnet, "slots", lambda context, *rest: asked.append(len(context)) or slots(context, *rest))
    got = np.zeros_like(want)
    mixnet.count_bits(texts, got)
    mixnet.count_bits([], got)
    assert (got == want).all()
    assert sum(asked) * 10 < mixnet.ORDERS * len(raw)


def test_words_asked_for(monkeypatch):
    rows = pd.DataFrame({"block": [0, 1, 0, 1], "text": ["A b", "b c", "a D", ""]})
    want = [(0, w) for w in (b"a", b"b", b"d")] + [(1, w) for w in (b"b", b"c")]
    want = sorted((block, lm.word_key(w)) for block, w in want)
    one, = lm._asked(iter([rows]))
    assert sorted(zip(one["block"], one["word"])) == want and one["word"].dtype == np.int64
    monkeypatch.setattr(lm, "MOST_COUNTED", 3)
    several = list(lm._asked(iter([rows, rows])))
    assert all(len(x) <= 4 for x in several) and {x for part in several for x in zip(part["block"], part["word"])} == set(want)
    assert [len(x) for x in lm._asked(iter([]))] == [0]


def test_pieces_do_not_change_contexts():
    text = mixnet.stream([b"word%d" % (i * i) for i in range(500)])
    whole, _, all_at_once = mixnet.contexts([(text, 0)])
    raw, _, hashes = mixnet.contexts(mixnet.pieces(text, 100))
    assert len(mixnet.pieces(text, 100)) > 20
    assert (raw == whole).all() and (hashes == all_at_once).all()


def test_scores(documents):
    rng = random.Random(5)
    words = [f"{a}{b}" for a in ("The", "ing", "er", "Ha", "st") for b in ("on", "re", "ti", "ou")]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 300))), "s") for i in range(120)] + ODD
    got = score_texts(documents(rows)).collect()
    assert len(got) == len(rows)
    fold = lambda i: 9 if i is None else zlib.crc32(str(i).encode()) % 10
    split = [(i, [w.lower() for w in (t or "").encode().split()] + [b"\n"]) for i, t, _ in rows]
    counts = Counter(w for i, ws in split if fold(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = sorted((repr(i), fold(i) == 0, len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 6)) for i, ws in split)
    assert sorted((repr(r["id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    held = [r for r in got if r["held_out"] and r["n_tokens"] == r["n_known"] > 20]
    assert held and sum(r["score"] for r in held) > 1.15 * sum(r["base_score"] for r in held)
    assert score_texts(documents([])).count() == 0


def test_texts_to_score_are_dealt_once(documents):
    scored = score_texts(documents([(i, f"word{i % 7} other {i}", "s") for i in range(60)] + ODD))
    assert len(scored.collect()) == 60 + len(ODD)
    final = plan_of(scored).split("Initial Plan")[0]
    assert "ReusedExchange" in final
    by_word = [line for line in final.splitlines() if "hashpartitioning" in line and "word" in line]
    assert by_word and not any("block" in line for line in by_word)  # none only to make words distinct


def brute_nearest(rows, top=20, every=20):
    rows = sorted({(i, tuple(v)) for i, v in rows})
    out = {}
    for q, x in rows:
        if q % every == 0:
            scored = sorted(((-float(np.dot(np.array(x), np.array(y))), i) for i, y in rows if i != q))[:top]
            out[q] = [(i, -s) for s, i in scored]
    return out


def test_nearest_with_odd_vectors(spark):
    rng = np.random.default_rng(6)
    good = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    good += [(300 + i, good[7][1]) for i in range(60)]  # one vector many times
    odd = [(1000, None), (1020, []), (1040, [0.0] * 8), (1060, [float("nan")] + [1.0] * 7), (1080, [None] + [1.0] * 7), (1100, [float("inf")] + [1.0] * 7), (1120, [1.0] * 5), (None, [1.0] * 8)]
    rows = good + odd + good[:5]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as query", "2 as vec")
    got = {}
    for r in nearest(vectors).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    want = brute_nearest(good)
    assert got.keys() == want.keys()
    for q, own in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in own]
        assert np.allclose([s for _, s in got[q]], [s for _, s in own], atol=1e-12)
    assert nearest(vectors.where("false")).count() == 0


def test_recall_of_the_index():
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(4096, 64))
    vectors /= np.sqrt(np.square(vectors).sum(axis=1, keepdims=True))
    pivots = np.c_[vectors[: permindex.PIVOTS], np.zeros(permindex.PIVOTS)]
    shard = permindex.Shard(vectors, pivots, 1.0)
    found = 0
    for q in range(100):
        true = set(np.argsort(-(vectors @ vectors[q]))[:20].tolist())
        rows = shard.candidates(permindex.prefixes(vectors[q : q + 1], pivots, None)[0], max(permindex.LEAST_RERANKED, int(permindex.RERANKED * 4096)))
        found += len(true & set(rows.tolist()))
    assert found / 2000 >= 0.9
