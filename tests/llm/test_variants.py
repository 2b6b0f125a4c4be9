import random
import re
import zlib
from collections import Counter

import pytest

from pactlens.llm.queries import QUERIES
from pactlens.llm.variants import Signatures, near_pairs, variant_groups

from .conftest import ODD
from .test_neardup_substring import distance, edit


def brute_counts(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda x: x[0].lower(), run)
            h = zlib.crc32(f"{i}:{word}".encode())
            if i is not None and h % 31 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            if len(word) >= 7:
                counts[word] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def brute_groups(counts):
    forms, near = {}, {}
    for w, n in counts.items():
        near[w] = [x for x in counts if abs(len(x) - len(w)) < 2 and x != w and distance(w, x) == 1]
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        forms[w] = best if best and counts[best] >= 10 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), counts.get(forms[w])))
    return sorted(out)


def test_one_edit_leaves_a_partition_equal():
    rng = random.Random(2)
    signatures = Signatures()
    for _ in range(2000):
        a = "".join(rng.choice("abcde") for _ in range(rng.randint(7, 12)))
        b = "".join(edit(rng, a, 1, "abcde"))
        assert any(x == y for x, y in zip(signatures.partition_hashes(a), signatures.partition_hashes(b), strict=True))


@pytest.mark.parametrize("group", [256, 4])
def test_pairs_against_all_pairs(spark, group):
    rng = random.Random(group)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(7, 9))) for _ in range(150)}
    for w in list(words):
        words |= {x for _ in range(2) if len(x := "".join(edit(rng, w, rng.randint(1, 2), "abçd"))) >= 7}
    words = sorted(words)
    got = near_pairs(spark.createDataFrame([(w, len(w)) for w in words], "word string, n long"), group).collect()
    pairs = [(frozenset((r["a"], r["b"])), r["an"] == len(r["a"]) and r["bn"] == len(r["b"])) for r in got]
    want = {frozenset((a, b)) for i, a in enumerate(words) for b in words[:i] if distance(a, b) == 1}
    assert len(want) > 100 and all(ok for _, ok in pairs)
    assert len(pairs) == len(want) and {p for p, _ in pairs} == want


def test_forms_are_followed_to_the_root(spark):
    counts = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2000, "abcdefghik": 2000, "zzzzzzz": 5, "zzzzzzzz": 49}
    got = variant_groups(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    assert sorted(map(tuple, got), key=lambda r: r[0]) == brute_groups(counts)
    assert {r["word"]: r["root"] for r in got}["abcdefg"] == "abcdefghij"


def test_query_against_brute_force(spark, documents, tmp_path):
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdeÀéÉ×") for _ in range(rng.randint(7, 10))) for _ in range(25)]
    rows = []
    for i in range(160):
        own = [rng.choice(base[: rng.randint(1, 25)]) for _ in range(12)]
        own = ["".join(edit(rng, w, 1, "abcdeXé")) if rng.random() < 0.15 else w for w in own]
        rows.append((i, rng.choice([" ", ", ", "Ā", "_"]).join(own), "s"))
    rows += ODD + [(1 << 60, "Straßenbahn strasse Straßenbahn", None)] * 2
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_spelling_variants"](spark, str(tmp_path)).collect()
    want = brute_groups(brute_counts([(i, t) for i, t, _ in rows]))
    assert sorted(map(tuple, got)) == want and sum(r[1] is not None for r in want) > 5


def test_empty_table(spark, documents, tmp_path):
    documents([]).write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op12_spelling_variants"](spark, str(tmp_path)).collect() == []
