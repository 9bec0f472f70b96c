import hashlib

import numpy as np
import pytest

from sporemill.operators import ecology, ordination, permute


def distances(spark, m, names):
    rows = [(names[i], names[j], float(m[i, j])) for i in range(len(names)) for j in range(i + 1, len(names))]
    return spark.createDataFrame(rows, "s1 string, s2 string, d double")


def statistic(m, g):
    n, k = len(g), len(set(g))
    total = (m**2).sum() / 2 / n
    within = sum((m[np.ix_(g == x, g == x)] ** 2).sum() / 2 / (g == x).sum() for x in set(g))
    return (total - within) / (k - 1) / (within / (n - k))


def dealt(names, groups, p):
    order = sorted(range(len(names)), key=lambda i: (hashlib.md5(f"{p}:{names[i]}perm".encode()).hexdigest(), names[i]))
    out = np.empty(len(names), object)
    out[order] = [g for g, _ in sorted(zip(groups, names))]
    return out


@pytest.mark.parametrize("places", [8, 256])
def test_permanova_in_blocks(spark, monkeypatch, places):
    """Blocks of eight make many pairs of blocks; results are those of every permutation by itself."""
    monkeypatch.setattr(permute, "PLACES", places)
    monkeypatch.setattr(permute, "CHUNK", 16)
    rng = np.random.default_rng(3)
    names = [f"s{i}" for i in range(45)]
    groups = [f"g{i % 3}" for i in range(45)]
    points = rng.normal(size=(45, 4)) + 0.3 * np.array([i % 3 for i in range(45)])[:, None]
    m = np.linalg.norm(points[:, None] - points[None], axis=2)
    d = distances(spark, m, names)
    g = spark.createDataFrame([*zip(names, groups), ("s99", "g1"), ("x", None)], "sample string, grp string").where("sample <> 's99'")
    got = ecology.permanova(d, g, 99).first()
    real = statistic(m, np.array(groups, object))
    others = [statistic(m, dealt(names, groups, p)) for p in range(1, 100)]
    assert got.f == pytest.approx(real) and got.p == (sum(x >= real - 1e-12 for x in others) + 1) / 100 and got.df == 2
    pairs = {(r.g1, r.g2): r for r in ecology.pairwise_permanova(d, g, 99).collect()}
    assert set(pairs) == {("g0", "g1"), ("g0", "g2"), ("g1", "g2")}
    for (a, b), r in pairs.items():
        at = [i for i in range(45) if groups[i] in (a, b)]
        own, sub, some = [names[i] for i in at], m[np.ix_(at, at)], [groups[i] for i in at]
        real = statistic(sub, np.array(some, object))
        p = (sum(statistic(sub, dealt(own, some, q)) >= real - 1e-12 for q in range(1, 100)) + 1) / 100
        assert r.f == pytest.approx(real) and r.p == p and r.adjusted == min(1, 3 * p)
    z = {r["sample"]: r.z for r in ecology.centroid_distances(d, g).collect()}
    values = np.array([z[n] for n in names])

    def spread(labels):
        b = sum((labels == x).sum() * (values[labels == x].mean() - values.mean()) ** 2 for x in set(groups))
        w = sum(((values[labels == x] - values[labels == x].mean()) ** 2).sum() for x in set(groups))
        return b / 2 / (w / 42)

    f = spread(np.array(groups, object))
    got = ecology.dispersion(d, g, 99).first()
    assert got.f == pytest.approx(f) and got.p == (sum(spread(dealt(names, groups, p)) >= f - 1e-12 for p in range(1, 100)) + 1) / 100


def test_nothing_to_permute(spark):
    none = spark.createDataFrame([], "s1 string, s2 string, d double")
    g = spark.createDataFrame([("a", None)], "sample string, grp string")
    assert ecology.permanova(none, g, 9).count() == 0 and ecology.dispersion(none, g, 9).count() == 0
    assert ecology.pairwise_permanova(none, g, 9).count() == 0


def coordinates(m, axes):
    n = len(m)
    j = np.eye(n) - 1 / n
    values, vectors = np.linalg.eigh(-0.5 * j @ m**2 @ j)
    values, vectors = values[::-1], vectors[:, ::-1]
    return values[:axes], vectors[:, :axes] * np.sqrt(np.maximum(values[:axes], 0)), values.sum()


@pytest.mark.parametrize("most", [120, 16])
def test_principal_coordinates_of_two_hundred_samples(spark, most):
    """Distances that no points in space have; few columns make the search begin anew."""
    rng = np.random.default_rng(8)
    x = rng.gamma(0.4, size=(200, 30)) * np.r_[20, 10, 5, np.ones(27)]
    m = np.abs(x[:, None] - x[None]).sum(2) / (x.sum(1)[:, None] + x.sum(1)[None])
    names = [f"s{i}" for i in range(200)]
    got = {r["sample"]: r for r in ordination.principal_coordinates(distances(spark, m, names), 3, most=most, tolerance=1e-6).collect()}
    values, want, trace = coordinates(m, 3)
    for i in range(3):
        mine = np.array([got[n][f"axis{i + 1}"] for n in names])
        assert np.abs(mine - want[:, i] * np.sign(mine @ want[:, i])).max() < 1e-4 and mine[np.abs(mine).argmax()] > 0
        assert got["s0"][f"share{i + 1}"] == pytest.approx(values[i] / trace)


def test_few_and_equal_samples(spark):
    two = {r["sample"]: (r.axis1, r.axis2) for r in ordination.principal_coordinates(distances(spark, np.array([[0, 4.0], [4, 0]]), ["a", "b"])).collect()}
    assert {round(abs(x), 9) for x, _ in two.values()} == {2.0} and all(abs(y) < 1e-9 for _, y in two.values())
    same = ordination.principal_coordinates(distances(spark, np.zeros((3, 3)), ["a", "b", "c"])).collect()
    assert len(same) == 3 and all(r.axis1 == r.axis2 == 0 for r in same)
    none = ordination.principal_coordinates(spark.createDataFrame([], "s1 string, s2 string, d double"))
    assert none.count() == 0 and none.columns == ["sample", "axis1", "axis2", "share1", "share2"]


def test_ordination_query(spark):
    """The registered query against an eigendecomposition of the same distances."""
    from sporemill.plans import queries, views

    sf = "/root/testdata/sf0.001"
    d = ecology.bray_curtis(views.counts(spark, sf)).collect()
    names = sorted({r.s1 for r in d} | {r.s2 for r in d})
    m = np.zeros((len(names), len(names)))
    for r in d:
        m[names.index(r.s1), names.index(r.s2)] = m[names.index(r.s2), names.index(r.s1)] = r.d
    values, want, trace = coordinates(m, 3)
    got = {r["sample"]: r for r in queries.QUERIES["ordination_axes"](spark, sf).collect()}
    assert sorted(got) == names
    for i in range(3):
        mine = np.array([got[n][f"axis{i + 1}"] for n in names])
        assert np.abs(mine - want[:, i] * np.sign(mine @ want[:, i])).max() < 2e-5 and got[names[0]][f"share{i + 1}"] == pytest.approx(values[i] / trace, abs=1e-5)


@pytest.mark.parametrize("places", [8, 256])
def test_indicators_in_blocks(spark, monkeypatch, places):
    """Against every permutation by itself; an OTU outside the groups and a sample without a group say nothing."""
    monkeypatch.setattr(permute, "PLACES", places)
    monkeypatch.setattr(permute, "CHUNK", 16)
    rng = np.random.default_rng(9)
    names, groups = [f"s{i}" for i in range(20)], [f"g{i % 2}" for i in range(20)]
    m = rng.poisson(1.0, (6, 20)) * (1 + 3 * (rng.random((6, 1)) < 0.5) * (np.arange(20) % 2))
    rows = [(f"o{o}", s, int(m[o, i])) for o in range(6) for i, s in enumerate(names) if m[o, i]]
    c = spark.createDataFrame([*rows, ("o0", "x", 50), ("alone", "x", 1)], "otu string, sample string, n long")
    g = spark.createDataFrame([*zip(names, groups), ("x", None)], "sample string, grp string")

    def best(labels):
        each = np.stack([[m[:, labels == x].mean(1), (m[:, labels == x] > 0).mean(1)] for x in ("g0", "g1")])
        stat = np.sqrt(each[:, 0] / each[:, 0].sum(0) * each[:, 1])
        return stat.max(0), np.where(stat[1] >= stat[0], "g1", "g0")

    real, which = best(np.array(groups, object))
    others = np.array([best(dealt(names, groups, p))[0] for p in range(1, 51)])
    got = {r.otu: r for r in ecology.indicators(c, g, 50).collect()}
    assert set(got) == {f"o{o}" for o in range(6)}
    for o in range(6):
        r = got[f"o{o}"]
        assert r.stat == pytest.approx(real[o]) and r.grp == which[o] and r.p == pytest.approx(((others[:, o] >= real[o] - 1e-12).sum() + 1) / 51)
    none = g.where("false")
    assert ecology.indicators(c, none, 9).count() == 0 and ecology.indicators(c.where("false"), g, 9, "phi").count() == 0
