import numpy as np
import pytest

from pactlens.llm.lines import SITES, drop_boilerplate
from pactlens.llm.mixing import apply_mix, fly, fly_and_land, mix

from .conftest import ODD


def brute_lines(rows, sites=SITES):
    spread, whole = {}, {}
    for _, text, site in rows:
        whole.setdefault(text or "", set()).update([site] if site is not None else [])
        for line in (text or "").split("\n"):
            if line.strip(" \t\n\x0b\x0c\r"):
                spread.setdefault(line.strip(" \t\n\x0b\x0c\r"), set()).update([site] if site is not None else [])
    out = []
    for i, text, _ in rows:
        lines = (text or "").split("\n")
        gone = [len(spread.get(x.strip(" \t\n\x0b\x0c\r"), ())) >= sites > len(whole[text or ""]) for x in lines]
        out.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return out


@pytest.mark.parametrize("spread", [SITES - 1, SITES, SITES + 1, 3 * SITES])
def test_lines_against_brute_force(documents, spread):
    rows = [(i, f"own line number {i} which is long enough\n  boiler plate \nmore own {i}\n", f"site{i}") for i in range(spread)]
    rows += [(100 + i, "boiler plate", f"site{i}") for i in range(4)]  # lose everything
    rows += [(110 + i, f"Short {i}.\nboiler plate", f"site{i}") for i in range(4)]  # lose most of their characters
    rows += [(300 + i, "a copied text\nof two lines\n", f"site{i}") for i in range(SITES)]  # whole on many sites
    rows += [(400, "a copied text\nand a line of its own", "site0")]
    rows += [(200, "boiler plate\nnull site and a line of its own", None), (201, None, "s"), (202, "", "s")]
    got = [(r["row"]["doc_id"], r["n_lines"], r["n_removed"], r["kept"]) for r in drop_boilerplate(documents(rows)).collect()]
    assert sorted(got) == sorted(brute_lines(rows))


def test_lines_of_odd_rows_and_none(documents):
    assert drop_boilerplate(documents(ODD)).count() == len(ODD)
    assert drop_boilerplate(documents([])).count() == 0


def test_flight_keeps_totals_and_chances():
    draws = np.random.default_rng(1)
    size = draws.integers(1, 500, 300).astype(float)
    p, ones = np.full(300, 0.37), np.ones(300)
    out = fly(p, ones, size, draws)
    open_ = (out > 0) & (out < 1)
    assert open_.sum() <= 2
    assert out.sum() == pytest.approx(p.sum()) and (out * size).sum() == pytest.approx((p * size).sum())
    mean = np.mean([fly(p[:12], ones[:12], size[:12], np.random.default_rng(k)) for k in range(3000)], axis=0)
    assert np.abs(mean - 0.37).max() < 0.05


def test_landing_comes_near():
    draws = np.random.default_rng(2)
    size = np.sort(draws.integers(1, 2000, 400).astype(float))[::-1]
    out = fly_and_land(np.full(400, 0.4), np.ones(400), size, draws)
    assert set(out) <= {0.0, 1.0}
    assert abs((out * size).sum() - 0.4 * size.sum()) < 30


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {s for s in names if sizes[s] == 0}
    while True:
        free = [s for s in names if s not in capped]
        share = (total - sum(3 * sizes[s] for s in capped)) / sum(weight[s] for s in free) if free else 0
        above = {s for s in free if weight[s] * share > 3 * sizes[s]}
        if not above:
            return {s: 3 * sizes[s] if s in capped else weight[s] * share for s in names}
        capped |= above


def test_mix_meets_targets(documents):
    draw = np.random.default_rng(3)
    rows = [(i, " ".join(["w"] * int(draw.integers(0, 60))), [None, "a", "ä", "b", "Z", "tiny"][i % 6 if i < 600 else 1]) for i in range(900)]
    rows = [(i, t if s != "tiny" else "w", s) for i, t, s in rows]
    units = mix(documents(rows)).collect()
    again = mix(documents(rows[::-1])).collect()
    assert sorted(map(repr, units)) == sorted(map(repr, again))
    sizes = {}
    for _, text, s in rows:
        sizes[s] = sizes.get(s, 0) + len(text.split())
    for s, target in brute_targets(sizes).items():
        own = [u for u in units if u["source"] == s]
        assert own[0]["target"] == pytest.approx(target) and own[0]["source_size"] == sizes[s]
        assert abs(sum(u["copies"] * u["size"] * u["n"] for u in own) - target) <= 30
        assert all(0 <= u["copies"] <= 3 for u in own)


def test_mix_of_odd_rows(documents):
    docs = documents(ODD)
    taken = {(u["k1"], u["k2"]): u for u in mix(docs).collect()}
    assert sum(u["n"] for u in taken.values()) == len(ODD)
    assert apply_mix(docs).count() == sum(u["n"] * u["copies"] for u in taken.values())
    assert apply_mix(docs).columns == docs.columns
    assert mix(documents([])).count() == 0
