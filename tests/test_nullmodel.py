import math

import numpy as np
import pytest

from sporemill.operators import ecology, nullmodel


def plain(cells, simulations, places):
    """The same null communities, every pair by itself."""
    own = {s: {o for o, t in cells if t == s} for s in sorted({s for _, s in cells})}
    weights = np.sort([sum(o == x for x, _ in cells) for o in {o for o, _ in cells}]).astype(float)
    names, null = list(own), {}
    for sim in range(simulations):
        for block in range(-(-len(names) // places)):
            some = names[block * places : (block + 1) * places]
            for s, row in zip(some, nullmodel.drawn(np.array([len(own[s]) for s in some]), weights, 1, sim, block)):
                null[sim, s] = set(np.flatnonzero(row))
                assert len(null[sim, s]) == len(own[s])
    out = {}
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            obs = len(own[a] & own[b])
            ge = sum(len(null[s, a] & null[s, b]) >= obs for s in range(simulations))
            out[a, b] = 1.0 if not obs else (ge + 1) / (simulations + 1)
    return out


@pytest.mark.parametrize("places", [3, 256])
def test_raup_crick_in_blocks(spark, monkeypatch, places):
    monkeypatch.setattr(nullmodel, "PLACES", places)
    rng = np.random.default_rng(2)
    cells = [(f"o{o}", f"s{s}") for s in range(8) for o in range(20) if rng.random() < 0.1 + 0.08 * s]
    odd = [("o1", None, 1), (None, "s1", 1), ("o2", "none", 0)]
    c = spark.createDataFrame([(o, s, 3) for o, s in cells] + [(*cells[0], 1)] + odd, "otu string, sample string, n long")
    got = {(r.s1, r.s2): r.d for r in ecology.raup_crick(c, 60).collect()}
    assert got == pytest.approx(plain(cells, 60, places))


def test_equal_weights_are_hypergeometric(spark):
    cells = [(f"o{o}", s) for s, some in (("a", range(0, 8)), ("b", range(2, 10)), ("c", [0, 1, 8, 9, 10, 11]), ("d", [10, 11])) for o in some]
    c = spark.createDataFrame([(o, s, 1) for o, s in cells], "otu string, sample string, n long")
    assert {len([1 for o, _ in cells if o == f"o{i}"]) for i in range(12)} == {2}
    got = {(r.s1, r.s2): r.d for r in ecology.raup_crick(c, 2000).collect()}
    chance = lambda x, m, n: math.comb(m, x) * math.comb(12 - m, n - x) / math.comb(12, n)
    assert got["a", "b"] == pytest.approx(sum(chance(x, 8, 8) for x in range(6, 9)), abs=0.04)
    assert got["a", "d"] == 1.0 and len(got) == 6
    assert ecology.raup_crick(c.where("false"), 9).count() == 0


def test_raup_crick_query(spark):
    from sporemill.plans import queries, views

    sf = "/root/testdata/sf0.001"
    cells = [(r.otu, r["sample"]) for r in views.counts(spark, sf).collect()]
    got = {(r.s1, r.s2): r.d for r in queries.QUERIES["raup_crick"](spark, sf).collect()}
    assert got == pytest.approx({k: round(x, 6) for k, x in plain(cells, 999, 256).items()})
