import hashlib
import math
import re
from collections import Counter

from pactlens.llm.fingerprint import BLOCK, _draw_logs, edited_fingerprints, signatures

from .conftest import ODD


def jaccard(a, b):
    a, b = Counter(a.encode().split()), Counter(b.encode().split())
    return sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0


def test_likeness_follows_generalised_jaccard(documents):
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(words[(i * j) % 60] for j in range(20 + 5 * i)), "s") for i in range(1, 41)]
    got = {r["doc_id"]: r for r in edited_fingerprints(documents(rows)).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    errors = []
    for n, (i, text, _) in enumerate(order):
        after = order[(n + 1) % len(order)][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        assert got[i]["n_chars"] == len(text)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        errors += [got[i]["near_edited"] - jaccard(text, edited), got[i]["near_next"] - jaccard(text, after)]
    assert abs(sum(errors)) / len(errors) < 0.03
    assert max(map(abs, errors)) < 0.3


def test_odd_rows(documents):
    got = edited_fingerprints(documents(ODD)).collect()
    assert len(got) == len(ODD)
    twins = [r for r in got if r["doc_id"] == 1]
    assert twins[0]["fingerprint"] == twins[1]["fingerprint"]
    blank = {r["fingerprint"] for r in got if r["n_chars"] in (0, 3)}
    assert len(blank) == 1
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))


def test_order_ends_at_the_first_and_ties_go_by_text(documents):
    got = {r["n_chars"]: r for r in edited_fingerprints(documents([(2, "abcdef", "s"), (2, "bcdefghij", "s"), (1, "xyz", "s")])).collect()}
    edited = {6: "abcd" + "bc", 9: "bcdefg" + "xyz", 3: "xy" + "a"}
    for size, text in edited.items():
        assert got[size]["edited_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_single_and_no_document(documents):
    one = edited_fingerprints(documents([(7, "abc abc", "s")])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert edited_fingerprints(documents([])).collect() == []


def test_plan_has_no_python(spark, documents, capsys):
    edited_fingerprints(documents([(1, "a b c", "s")])).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_draws_take_one_logarithm(documents):
    rows = documents([(1, "a b b", "s"), (2, "a c", "s")]).selectExpr("doc_id", "text", "text as other")
    plan = signatures(rows, ["doc_id"], ["text", "other"])._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < len(re.findall(r"\b(?:log|ln)\(", plan.lower())) <= 2 * BLOCK + 3  # one for each draw of a bid in two columns, the weights, the table


def test_logs_of_draws(spark):
    logs = _draw_logs(spark).head()["_logs"]
    assert len(logs) == 1 << 13 and all(abs(x + math.log((k + 0.5) / 8192)) < 1e-12 for k, x in enumerate(logs))
