import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from pactlens.llm import suffixes
from pactlens.llm.queries import QUERIES
from pactlens.llm.suffixes import WINDOW, anchors, without_repeats

from .conftest import ODD


def brute_spans(texts):
    """Counts every window of every text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + WINDOW] for d in data for i in range(len(d) - WINDOW + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - WINDOW + 1):
            if seen[d[i : i + WINDOW]] > 1:
                gone[i : i + WINDOW] = True
        edges = np.flatnonzero(np.diff(np.r_[0, gone.astype(np.int8), 0])).tolist()
        out.append((len(d), [tuple(x) for x in zip(edges[::2], edges[1::2], strict=True)], bytes(x for x, g in zip(d, gone, strict=True) if not g)))
    return out


def corpus(rng, n):
    words = ["an", "the", "él", "ße", "tion", "x", " ", "\n", "日"]
    text = lambda size: "".join(rng.choice(words) for _ in range(size))
    passages = [text(rng.choice([60, 90, 120, 300])) for _ in range(6)]
    out = []
    for _ in range(n):
        t = text(rng.randint(0, 200))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 3)
            p = p[a : len(p) - rng.randint(0, len(p) // 3)]
            if rng.random() < 0.3:
                at = rng.randrange(len(p))
                p = p[:at] + rng.choice(["", "Q", "é"]) + p[at + 1 :]
            at = rng.randint(0, len(t))
            t = t[:at] + p + t[at:]
        out.append(t)
        if rng.random() < 0.1:
            out.append(out[rng.randrange(len(out))])
    return out


def test_equal_windows_have_equal_anchors(monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 300)
    rng = random.Random(1)
    data = "".join(corpus(rng, 12)).encode() + b"z" * 900 + b"ab" * 400
    key, place, first, last = anchors(data)
    assert first[0] == 0 and last[-1] == len(data) - WINDOW and (first[1:] == last[:-1] + 1).all()
    found = {}
    for k, p, a, b in zip(key.tolist(), place.tolist(), first.tolist(), last.tolist(), strict=True):
        for w in range(a, b + 1):
            assert w <= p <= w + WINDOW - suffixes.GRAM
            assert found.setdefault(data[w : w + WINDOW], (k, p - w)) == (k, p - w)


@pytest.mark.parametrize("large", [2000, 1])
def test_spans_against_all_windows(spark, documents, large):
    rng = random.Random(large)
    texts = [*corpus(rng, 120), "y" * 199, "q" * 200, "q" * 201, "v" * 300, "0123456789" * 50, None, ""]
    rows = [(i, t, "s") for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[5], None), (None, texts[5], None), (3, "other text of the same id " * 30, "s")]
    got = without_repeats(documents(rows), large=large).collect()
    want = [(i, *x) for (i, _, _), x in zip(rows, brute_spans([t for _, t, _ in rows]), strict=True)]
    got = [(r["id"], r["n_bytes"], [tuple(s) for s in r["spans"]], bytes(r["kept"])) for r in got]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(len(x[2]) for x in want) > 20


def test_query(spark, documents, tmp_path):
    rng = random.Random(7)
    rows = [(i, t, "s") for i, t in enumerate(corpus(rng, 30))] + ODD
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_suffix_dedup"](spark, str(tmp_path)).collect()
    want = [
        (i, n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
        for (i, _, _), (n, spans, kept) in zip(rows, brute_spans([t for _, t, _ in rows]), strict=True)
    ]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_empty_table(spark, documents):
    assert without_repeats(documents([])).collect() == []
