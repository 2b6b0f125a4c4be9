import hashlib
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from pactlens.llm import neardup
from pactlens.llm.graph import components
from pactlens.llm.neardup import NONE, REMAINDER, SHORT, all_keys, banded_distance, keep_one, near_duplicates, occurrences, order_sketches, similar
from pactlens.llm.substring import Anchors, Rolling, intervals, repeated_spans
from pactlens.llm.wordhash import WordHashes

from tests.conftest import plan_of

from .conftest import ODD


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edit(rng, words, n, alphabet):
    out = list(words)
    for _ in range(n):
        kind = rng.random()
        if kind < 0.3 and out:
            del out[rng.randrange(len(out))]
        elif kind < 0.6:
            out.insert(rng.randint(0, len(out)), rng.choice(alphabet))
        elif out:
            out[rng.randrange(len(out))] = rng.choice(alphabet)
    return out


def test_band_against_whole_table():
    rng = random.Random(0)
    for _ in range(1500):
        a = [rng.randint(0, rng.choice([2, 30])) for _ in range(rng.randint(0, 60))]
        b = edit(rng, a, rng.randint(0, 25), range(30))
        most, true = rng.randint(0, 40), distance(a, b)
        got = banded_distance(a, b, most)
        assert got == true if true <= most else got > most


def test_alignment_is_never_shorter_and_spares_the_table(monkeypatch):
    rng = random.Random(2)
    for _ in range(500):
        a = [rng.randint(0, rng.choice([3, 60])) for _ in range(rng.randint(0, 60))]
        b = edit(rng, a, rng.randint(0, 25), range(30))
        most = neardup.most_edits(max(len(a), len(b)))
        assert neardup.aligned_distance(a, b, Counter(a), Counter(b)) >= distance(a, b)
        assert similar(a, b) == (distance(a, b) <= most)
    monkeypatch.setattr(neardup, "banded_distance", None)
    a = list(range(400))
    assert similar(a, edit(rng, a, 40, range(10**6)))


def test_one_call_compares_many_tasks():
    rng = random.Random(3)
    texts = [[rng.randint(0, 40) for _ in range(rng.randint(20, 30))] for _ in range(60)]
    texts += [edit(rng, t, 3, range(40)) for t in texts] + [[7] * 300, [7] * 290]  # a class beyond a byte
    batch = pd.DataFrame({"node": range(len(texts)), "text": [" ".join(map(str, t)) for t in texts]})
    known = next(neardup._sketch_rows(neardup.SIMILARITY)(iter([batch])))
    assert sorted(set(map(len, known["classes"]))) == [neardup.CLASSES, 4 * neardup.CLASSES]
    rows, want = [], set()
    for task in range(30):
        left, right = rng.sample(range(len(texts)), 12), rng.sample(range(len(texts)), 9) if task % 2 else []
        rows += [(task, 0, n, n % 7) for n in left] + [(task, 1, n, n % 7) for n in right]
        want |= {tuple(sorted((x, y))) for x in left for y in (right or left) if x % 7 != y % 7 and similar(texts[x], texts[y])}
    rows = pd.DataFrame(rows, columns=["task", "side", "node", "label"]).sample(frac=1, random_state=1).merge(known, on="node")
    found = neardup._block_pairs(neardup.SIMILARITY)(rows)
    got = {tuple(sorted(p)) for p in found.itertuples(index=False)}
    assert want and want <= got and all(x % 7 != y % 7 for x, y in got)


def test_marks_lose_no_pair_and_tell_long_texts_apart():
    rng = random.Random(11)
    common = [rng.randrange(10**9) for _ in range(600)]
    texts = [common + [rng.randrange(10**9) for _ in range(200)] for _ in range(40)]
    texts += [edit(rng, t, 60, range(10**9)) for t in texts[:10]] + [[3] * 700 + common[:200], [3] * 650 + common[:220], list(range(5000)), list(range(4900))]
    batch = pd.DataFrame({"node": range(len(texts)), "text": [" ".join(map(str, t)) for t in texts]})
    known = next(neardup._sketch_rows(neardup.SIMILARITY)(iter([batch])))
    known = known.merge(next(neardup._mark_rows(iter([batch]))), on="node")
    found = neardup._block_pairs(neardup.SIMILARITY)(known.assign(task=0, side=0, label=known["node"]))
    got = {tuple(sorted(p)) for p in found.itertuples(index=False)}
    want = {(i, j) for j in range(len(texts)) for i in range(j) if similar(texts[i], texts[j])}
    assert len(want) >= 12 and want <= got
    assert len(got - want) < 10  # by classes alone nearly all of the 40 texts' 780 pairs


def test_large_groups_are_cut_into_blocks(documents, corpus, monkeypatch):
    at_once = {r["row"]["doc_id"]: r["class_id"] for r in near_duplicates(documents(corpus)).collect()}
    written, write = {}, neardup.materialize

    def seen(df, label):
        written[label] = write(df, label)
        return written[label]

    monkeypatch.setattr(neardup, "materialize", seen)
    near_duplicates(documents(corpus)).collect()
    whole = written["block-members"].count()
    assert whole == written["mixed-members"].count() > 0  # a group of one block moves once, without a join
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 8)
    assert {r["row"]["doc_id"]: r["class_id"] for r in near_duplicates(documents(corpus)).collect()} == at_once
    assert written["mixed-blocks"].count() > 0 and written["block-members"].count() > whole


def test_blocks_name_each_pair_once(monkeypatch):
    monkeypatch.setattr(neardup, "STRIP_ROWS", 4)
    rng = random.Random(12)
    base = [rng.randrange(10**6) for _ in range(60)]
    texts = [edit(rng, base, 3, range(10**6)) for _ in range(30)]
    known = next(neardup._sketch_rows(neardup.SIMILARITY)(iter([pd.DataFrame({"node": range(30), "text": [" ".join(map(str, t)) for t in texts]})])))
    groups = {key: sorted(rng.sample(range(30), 18)) for key in range(12)}
    met = {n: np.array([k for k, g in groups.items() if n in g]) for n in range(30)}
    rows = pd.DataFrame([(k, k, 0 if i < 10 or k % 2 else 1, n) for k, g in groups.items() for i, n in enumerate(g)], columns=["key", "task", "side", "node"])
    rows = rows.assign(label=rows["node"] % 5, met=rows["node"].map(met)).merge(known, on="node")
    found = neardup._block_pairs(neardup.SIMILARITY)(rows)
    got = [tuple(sorted(p)) for p in found.itertuples(index=False)]
    want = {(a, b) for k, g in groups.items() for i, a in enumerate(g) for j, b in enumerate(g) if a < b and a % 5 != b % 5 and (k % 2 or (i < 10) != (j < 10)) and k == min(set(met[a]) & set(met[b]))}
    assert len(got) == len(set(got)) and want == set(got)


def test_centres_need_no_join_by_key(documents, corpus, monkeypatch):
    plans, write = {}, neardup.materialize

    def seen(df, label):
        plans[label] = plan_of(df)
        return write(df, label)

    monkeypatch.setattr(neardup, "materialize", seen)
    neardup.near_duplicates(documents(corpus))
    joins = [line for line in plans["centre-pairs"].splitlines() if "Join" in line]
    assert joins and all("LeftAnti" in line for line in joins)


def test_occurrences_and_order_matter():
    values = np.array([5, 5, 7, 5, 7], np.uint64)
    assert occurrences(values).tolist() == [0, 1, 0, 2, 1]
    known = WordHashes()
    a = known.of([b"w%d" % i for i in range(200)])
    same = lambda x, y: float((order_sketches(x) == order_sketches(y)).mean())
    assert same(a, a) == 1.0
    near = a.copy()
    near[100] = 1
    turned = np.concatenate([a[100:], a[:100]])  # the same shingles but for a few, in another order
    assert same(a, near) > 0.7 > same(a, turned) > 0.2


def test_components_of_long_and_hot_graphs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(300, 301), (301, 300), (500, 500)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(60)) and got[301] == 300 and 500 not in got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    alphabet = [f"w{i}" for i in range(3000)]
    passage = [rng.choice(alphabet) for _ in range(60)]
    rows, i = [], 0
    for g in range(25):
        base = [rng.choice(alphabet) for _ in range(rng.randint(60, 250))]
        for _ in range(rng.randint(1, 5)):
            rows.append((i, " ".join(edit(rng, base, rng.randint(0, len(base) // 14), alphabet)), "s"))
            i += 1
    for _ in range(40):  # one passage in documents that are otherwise different
        rows.append((i, " ".join([rng.choice(alphabet) for _ in range(70)] + passage + [rng.choice(alphabet) for _ in range(50)]), "s"))
        i += 1
    rows += [(1000 + k, rows[3][1], "t") for k in range(3)]
    return rows


def test_near_duplicates_against_all_pairs(documents, corpus):
    split = [(i, t.encode().split()) for i, t, _ in corpus]
    label = {i: i for i, _ in split}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for n, (i, a) in enumerate(split):
        for j, b in split[:n]:
            if similar(a, b):
                x, y = sorted((root(i), root(j)))
                label[y] = x
    got = {r["row"]["doc_id"]: r["class_id"] for r in near_duplicates(documents(corpus)).collect()}
    assert got == {i: root(i) for i, _ in split}
    kept = keep_one(documents(corpus))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({root(i) for i, _ in split})


def pairs_at(rng, alphabet, sizes, turn):
    """Rows and pairs of ids: texts of own words, each with a copy that has as many edits as similarity 0.8 allows."""
    rows, pairs = [], []
    for n in sizes:
        base = [rng.choice(alphabet) for _ in range(n)]
        pairs.append((len(rows), len(rows) + 1))
        rows += [(len(rows), " ".join(base), "s"), (len(rows) + 1, " ".join(turn(base, n // 5)), "s")]
    return rows, pairs


def found_share(rows, pairs, documents):
    by_id = {r["row"]["doc_id"]: r["class_id"] for r in near_duplicates(documents(rows)).collect()}
    split = {i: t.encode().split() for i, t, _ in rows}
    true = [(a, b) for a, b in pairs if similar(split[a], split[b])]
    assert len(true) > len(pairs) / 2
    return sum(by_id[a] == by_id[b] for a, b in true) / len(true)


def test_no_pair_of_tiny_texts_is_lost(documents):
    rng, alphabet = random.Random(7), [f"w{i}" for i in range(5000)]
    rows, pairs = pairs_at(rng, alphabet, [5, 6, 7, 8, 9, 10, 11, 12, 13] * 12, lambda base, n: edit(rng, base, n, alphabet))
    plain = [f"p{i}" for i in range(14)]
    for a, b in ((plain[:5], plain[:4]), (plain[5:11], [*plain[5:10], "other"])):
        pairs.append((len(rows), len(rows) + 1))
        rows += [(len(rows), " ".join(a), "s"), (len(rows) + 1, " ".join(b), "s")]
    assert found_share(rows, pairs, documents) == 1


def test_pairs_at_the_threshold_are_found(documents):
    rng, alphabet = random.Random(8), [f"w{i}" for i in range(5000)]
    spaced = lambda base, n: [f"new{i}" if i % 5 == 2 else w for i, w in enumerate(base)]
    assert found_share(*pairs_at(rng, alphabet, [15, 20, 25, 40, 60, 80] * 20, spaced), documents) >= 0.97

    def scattered(base, n):
        out = list(base)
        for place in rng.sample(range(len(out)), n):
            out[place] = rng.choice(alphabet)
        return out

    assert found_share(*pairs_at(rng, alphabet, [90, 150, 300] * 50, scattered), documents) >= 0.9


def replaced(rng, base, places):
    return [rng.randrange(10**9) if i in places else w for i, w in enumerate(base)]


def inserted(rng, base, places):
    return [x for i, w in enumerate(base) for x in ((rng.randrange(10**9), w) if i in places else (w,))]


def deleted(rng, base, places):
    return [w for i, w in enumerate(base) if i not in places]


def meet(a, b):
    hashed = [all_keys(np.array(x, np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for x in (a, b)]
    x, y = hashed
    places = (x[:REMAINDER] == y[:REMAINDER]) & (x[:REMAINDER] != NONE)
    return bool(places.any() or set(x[REMAINDER:].tolist()) & set(y[REMAINDER:].tolist()))


@pytest.mark.parametrize("similarity", [0.8, 0.84])
@pytest.mark.parametrize("edit_at", [replaced, inserted, deleted])
@pytest.mark.parametrize("spread", ["random", "even"])
def test_similar_texts_share_keys_at_any_length(similarity, edit_at, spread):
    rng = random.Random(9)
    for n in (5, 10, 15, 20, 40, SHORT, SHORT + 2, 101, 126, 150, 400):
        n_edits = int((n / similarity - n if edit_at is inserted else n - similarity * n) + 1e-9)
        found = tried = 0
        for _ in range(100):
            base = [rng.randrange(10**9) for _ in range(n)]
            even = {int((i + 0.5) * n / n_edits) for i in range(n_edits)}
            other = edit_at(rng, base, even if spread == "even" else set(rng.sample(range(n), n_edits)))
            if similar(base, other):
                tried, found = tried + 1, found + meet(base, other)
        assert tried and found >= 0.95 * tried, (n, found, tried)


def test_long_texts_with_spaced_edits_are_found(documents):
    rng, alphabet = random.Random(10), [f"w{i}" for i in range(5000)]
    spaced = lambda base, n: [f"new{i}" if i % 5 == 2 else w for i, w in enumerate(base)]
    assert found_share(*pairs_at(rng, alphabet, [82, 100, 150, 400] * 20, spaced), documents) >= 0.95


def test_near_duplicates_of_odd_rows(documents):
    rows = near_duplicates(documents(ODD)).collect()
    assert len(rows) == len(ODD)
    kept = keep_one(documents(ODD))
    # One each of: alpha beta gamma; empty (null counts as empty); blanks; alpha beta; x...; w...; other text.
    assert kept.count() == 7 and kept.columns == documents(ODD).columns
    assert near_duplicates(documents([])).count() == 0


def test_rolling_hashes_of_runs():
    h = WordHashes().of([b"a", b"b", b"c", b"a", b"b", b"c", b"d"])
    r = Rolling(h)
    one, two = r.runs(np.array([0, 3]), 3)
    assert one == two and r.runs(np.array([0]), 4)[0] != r.runs(np.array([3]), 4)[0]
    n = 400
    anchors = Anchors(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    covered = [p for a, b in zip(anchors.first, anchors.last) for p in range(a, b + 1)]
    assert covered == list(range(n - 35 + 1))
    assert intervals(np.array([1, 1, 0, 1], bool)) == [(0, 2), (3, 4)]


def brute_spans(rows, window=35):
    split = [(t or "").encode().split() for _, t, _ in rows]
    counts = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for (i, _, _), w in zip(rows, split):
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if counts[tuple(w[p : p + window])] > 1:
                gone[p : p + window] = [True] * window
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return out


def test_substrings_against_all_windows(documents, corpus):
    extra = [(2000, " ".join(["same"] * 80), "s"), (2001, " ".join(["same"] * 35), "s"), (2002, " ".join(f"p{i % 36}" for i in range(150)), "s")]
    rows = corpus + extra + ODD
    got = [(r["id"], r["n_words"], sum(s["stop"] - s["start"] for s in r["spans"]), r["kept_sha256"]) for r in repeated_spans(documents(rows)).collect()]
    assert sorted(got, key=repr) == sorted(brute_spans(rows), key=repr)
    assert repeated_spans(documents([])).count() == 0
