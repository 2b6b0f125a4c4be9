import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from pactlens.llm.queries import QUERIES
from pactlens.llm.runs import collapsed, find_runs, periodic_runs
from pactlens.llm.wordhash import WordHashes

from .conftest import ODD


def brute_runs(w):
    """Every period at every place, extended word by word."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def random_words(rng):
    out = [b"%d" % rng.randrange(rng.choice([1, 2, 3, 40])) for _ in range(rng.randint(0, 40))]
    for _ in range(rng.randint(0, 3)):
        part = [b"%d" % rng.randrange(4) for _ in range(rng.randint(1, 9))]
        if rng.random() < 0.4:
            part = part[:1] * rng.randint(1, 4) + part
        at = rng.randint(0, len(out))
        out[at:at] = (part * 12)[: rng.randint(1, 7 * len(part))]
    return out


def test_runs_against_all_periods():
    rng = random.Random(3)
    known = WordHashes()
    some = 0
    for _ in range(6000):
        own = random_words(rng)
        got = find_runs(own, known.of(own))
        assert got == brute_runs(own), own
        some += len(got)
    assert some > 2000


@pytest.mark.parametrize("period", [1, 2, 7, 600])
def test_long_periodic_text(period):
    own = [b"start", *([b"w%d" % (i % period) for i in range(20_000)]), b"end"]
    assert find_runs(own, WordHashes().of(own)) == [(1, 20_000, period)]
    assert collapsed(own, [(1, 20_000, period)]) == [b"start", *own[1 : 1 + period], b"end"]


def test_common_passage_with_many_left_words():
    own = [w for i in range(3000) for w in (b"left%d" % i, b"a", b"b", b"c", b"d", b"e", b"f")]
    assert find_runs(own, WordHashes().of(own)) == []


def test_limits_are_checked():
    with pytest.raises(ValueError):
        find_runs([b"a"] * 9, WordHashes().of([b"a"] * 9), exponent=2)


def brute_rows(rows):
    out = []
    for i, text in rows:
        w = [x for x in (text or "").encode().split()]
        if i is not None and w:
            h = zlib.crc32(str(i).encode())
            g, n = h // 10, len(w)
            if h % 10 == 0:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                w = [x if k < a else w[a + (k - a) % p] for k, x in enumerate(w)]
        runs = brute_runs(w)
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        text = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        out.append((i, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256(text.encode()).hexdigest(),
                    hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()))
    return sorted(out, key=repr)


def test_query_against_brute_force(spark, documents, tmp_path):
    rng = random.Random(5)
    rows = [(i, b" ".join(random_words(rng)).decode(), "s") for i in range(400)]
    rows += [(i, " ".join(rng.choice("ab") for _ in range(60)), "s") for i in range(400, 500)] + ODD
    rows.append((501, " ü\xa0x  ü\xa0x\tü\xa0x\nü\xa0x ü\xa0x ü\xa0x é", None))
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op11_periodic_runs"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=repr) == brute_rows([(i, t) for i, t, _ in rows])


def test_operator_keeps_its_own_outputs(spark, documents):
    got = periodic_runs(documents([(1, "a b c c c c c c d", "s"), (2, None, None)])).collect()
    assert [(r["id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got] == [
        (1, 9, [(2, 6, 1)], "a b c d"), (2, 0, [], ""),
    ]
    assert periodic_runs(documents([])).collect() == []
