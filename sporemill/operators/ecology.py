"""Community statistics on counts(otu, sample, n) and long distance tables dist(s1, s2, d), s1 < s2."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.order import numbered
from ..functions.scratch import materialise
from . import permute
from .nullmodel import raup_crick  # noqa: F401
from .ordination import principal_coordinates
from .permute import Families


def richness(counts: DataFrame) -> DataFrame:
    return counts.groupBy("sample").agg(F.count_distinct("otu").alias("observed"))


def pairs_of(samples: DataFrame) -> DataFrame:
    """All pairs of samples: the shape of a distance matrix, which is the result asked for."""
    s = samples.select("sample").distinct()
    return s.select(F.col("sample").alias("s1")).join(s.select(F.col("sample").alias("s2")), F.col("s1") < F.col("s2"))


def shared(counts: DataFrame, value) -> DataFrame:
    """(s1, s2, x): the sum of value(a, b) over the OTUs that both samples have."""
    a = counts.select("otu", F.col("sample").alias("s1"), F.col("n").alias("a"))
    b = counts.select("otu", F.col("sample").alias("s2"), F.col("n").alias("b"))
    return a.join(b, "otu").where("s1 < s2").groupBy("s1", "s2").agg(F.sum(value(F.col("a"), F.col("b"))).alias("x"))


def from_shared(counts: DataFrame, x: DataFrame, size, distance) -> DataFrame:
    t = counts.groupBy("sample").agg(size.alias("t"))
    every = pairs_of(counts).join(t.select(F.col("sample").alias("s1"), F.col("t").alias("t1")), "s1").join(t.select(F.col("sample").alias("s2"), F.col("t").alias("t2")), "s2")
    return every.join(x, ["s1", "s2"], "left").select("s1", "s2", distance(F.coalesce("x", F.lit(0)), F.col("t1"), F.col("t2")).alias("d"))


def bray_curtis(counts: DataFrame) -> DataFrame:
    return from_shared(counts, shared(counts, F.least), F.sum("n"), lambda x, a, b: 1 - 2 * x / (a + b))


def jaccard(counts: DataFrame) -> DataFrame:
    """On presence: 1 - shared / union."""
    return from_shared(counts, shared(counts, lambda a, b: F.lit(1)), F.count("*"), lambda x, a, b: 1 - x / (a + b - x))


def aitchison(counts: DataFrame, pseudo: float = 1.0) -> DataFrame:
    """Euclidean distance of centred log ratios over all OTUs, ``pseudo`` added to every cell.

    With u = log(n + pseudo) - log(pseudo), zero where there is no count, the distance follows from sums over cells that
    have counts, so the dense matrix is never made.
    """
    u = counts.select("otu", "sample", F.log((F.col("n") + pseudo) / pseudo).alias("n"))
    k = counts.select("otu").distinct().agg(F.count("*").alias("k"))
    t = u.groupBy("sample").agg(F.sum("n").alias("s"), F.sum(F.col("n") * F.col("n")).alias("q"))
    every = pairs_of(counts)
    for i in ("1", "2"):
        every = every.join(t.select(F.col("sample").alias(f"s{i}"), F.col("s").alias(f"sum{i}"), F.col("q").alias(f"sq{i}")), f"s{i}")
    x = shared(u, lambda a, b: a * b)
    d2 = F.col("sq1") + F.col("sq2") - 2 * F.coalesce("x", F.lit(0.0)) - F.pow(F.col("sum1") - F.col("sum2"), F.lit(2)) / F.col("k")
    return every.join(x, ["s1", "s2"], "left").join(F.broadcast(k)).select("s1", "s2", F.sqrt(F.greatest(d2, F.lit(0.0))).alias("d"))


def unifrac(counts: DataFrame, tree: DataFrame, weighted: bool = False) -> DataFrame:
    """tree(edge_id, length, leaf_otus). Unweighted: length of edges that only one sample has over that of edges that any
    has. Weighted: sum of length * |share difference|, over that of length * (share sum)."""
    t = counts.groupBy("sample").agg(F.sum("n").alias("t"))
    edges = tree.select("edge_id", "length", F.explode("leaf_otus").alias("otu"))
    mass = counts.join(edges, "otu").groupBy("edge_id", "sample").agg(F.first("length").alias("length"), F.sum("n").alias("m")).join(t, "sample")
    m = mass.select("edge_id", "sample", "length", (F.col("m") / F.col("t") if weighted else F.lit(1.0)).alias("m"))
    own = m.groupBy("sample").agg(F.sum(F.col("length") * F.col("m")).alias("o"))
    a, b = m.select("edge_id", "length", F.col("sample").alias("s1"), F.col("m").alias("a")), m.select("edge_id", F.col("sample").alias("s2"), F.col("m").alias("b"))
    both = a.join(b, "edge_id").where("s1 < s2").groupBy("s1", "s2").agg(F.sum(F.col("length") * F.least("a", "b")).alias("x"))
    every = pairs_of(counts)
    for i in ("1", "2"):
        every = every.join(own.select(F.col("sample").alias(f"s{i}"), F.col("o").alias(f"o{i}")), f"s{i}", "left").withColumn(f"o{i}", F.coalesce(f"o{i}", F.lit(0.0)))
    x, total = F.coalesce("x", F.lit(0.0)), F.col("o1") + F.col("o2")
    # sum |a-b| = sum (a+b) - 2 sum min; the union of presences is sum (a+b) - sum min
    d = F.when(total > 0, (total - 2 * x) / (total if weighted else total - x)).otherwise(0.0)
    return every.join(both, ["s1", "s2"], "left").select("s1", "s2", d.alias("d"))


def with_p(stat: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Statistics per perm to (keys, value, p): the share of permutations at least as large, the real one counted."""
    real = stat.where("perm = 0").select(*keys, F.col(value).alias("_real"))
    other = stat.where("perm > 0")
    j = other.join(F.broadcast(real), keys) if keys else other.join(F.broadcast(real))
    agg = j.groupBy(*keys, "_real").agg(F.count_if(F.col(value) >= F.col("_real") - 1e-12).alias("ge"), F.count("*").alias("k"))
    return agg.select(*keys, F.col("_real").alias(value), ((F.col("ge") + 1) / (F.col("k") + 1)).alias("p"))


def permanovas(dist: DataFrame, members: DataFrame, permutations: int) -> DataFrame:
    """(fam, df, f, r2, p): distances explained by each family's groups, members(fam, sample, grp)."""
    families = Families(members, permutations)
    w = families.within(dist).join(F.broadcast(families.sizes()), "fam").withColumn("all", F.col("total") / F.col("n"))  # a row a family
    between, df = F.col("all") - F.col("within"), F.col("k") - 1
    stat = w.select("fam", "perm", df.alias("df"), (between / df / (F.col("within") / (F.col("n") - F.col("k")))).alias("f"), (between / F.col("all")).alias("r2"))
    stat = materialise(stat, "permutations")
    return stat.where("perm = 0").select("fam", "df", "r2").join(with_p(stat, "f", ["fam"]), "fam").select("fam", "df", "f", "r2", "p")


def permanova(dist: DataFrame, groups: DataFrame, permutations: int = 9999) -> DataFrame:
    """One row (df, f, r2, p): distances explained by groups(sample, grp); none where no group has a distance."""
    return permanovas(dist, groups.select(F.lit("").alias("fam"), "sample", "grp"), permutations).drop("fam")


def centroid_distances(dist: DataFrame, groups: DataFrame) -> DataFrame:
    """(sample, grp, z): distance of each sample to its group's centroid, from distances alone."""
    g = groups.where("grp is not null")
    d = dist.select("s1", "s2", "d").union(dist.select(F.col("s2").alias("s1"), F.col("s1").alias("s2"), "d"))
    same = d.join(g.select(F.col("sample").alias("s1"), F.col("grp").alias("g1")), "s1").join(g.select(F.col("sample").alias("s2"), F.col("grp").alias("g2")), "s2").where("g1 = g2")
    size = g.groupBy("grp").agg(F.count("*").alias("m"))
    own = same.groupBy("s1", F.col("g1").alias("grp")).agg(F.sum(F.col("d") * F.col("d")).alias("s")).join(size, "grp")
    half = own.groupBy("grp").agg((F.sum("s") / F.first("m") / F.first("m") / 2).alias("h"))
    return own.join(half, "grp").select(F.col("s1").alias("sample"), "grp", F.sqrt(F.greatest(F.col("s") / F.col("m") - F.col("h"), F.lit(0.0))).alias("z"))


def dispersion(dist: DataFrame, groups: DataFrame, permutations: int = 9999) -> DataFrame:
    """One row (f, p): do groups differ in their samples' distances to the group centroid?"""
    z = materialise(centroid_distances(dist, groups).select(F.lit("").alias("fam"), "sample", "grp", "z"), "centroids")
    families = Families(z, permutations)
    per = families.sums(z.select("fam", "sample", F.col("z").alias("v"))).join(F.broadcast(families.group_sizes()), ["fam", "code"])  # a row a group
    q = z.agg(F.sum(F.col("z") * F.col("z")).alias("q"))
    t = per.groupBy("perm").agg(F.sum("m").alias("n"), F.count("*").alias("k"), F.sum("s").alias("s"), F.sum(F.col("s") * F.col("s") / F.col("m")).alias("b")).join(F.broadcast(q))
    between = F.col("b") - F.col("s") * F.col("s") / F.col("n")
    stat = t.select("perm", (between / (F.col("k") - 1) / ((F.col("q") - F.col("b")) / (F.col("n") - F.col("k")))).alias("f"))
    return with_p(materialise(stat, "permutations"), "f", [])


def stars(p) -> object:
    return F.when(p <= 0.001, "***").when(p <= 0.01, "**").when(p <= 0.05, "*").otherwise("")


def pairwise_permanova(dist: DataFrame, groups: DataFrame, permutations: int = 999) -> DataFrame:
    """(g1, g2, df, f, r2, p, adjusted, sig): PERMANOVA of each pair of groups, all in one dataflow, Bonferroni-adjusted."""
    g = groups.where("grp is not null").select("sample", "grp").distinct()
    names = g.select("grp").distinct()
    pairs = names.select(F.col("grp").alias("g1")).join(names.select(F.col("grp").alias("g2")), F.col("g1") < F.col("g2")).withColumn("fam", F.to_json(F.struct("g1", "g2")))
    members = pairs.select("fam", F.explode(F.array("g1", "g2")).alias("grp")).join(g, "grp")
    tests = pairs.join(permanovas(dist, members, permutations), "fam").drop("fam")
    adjusted = F.least(F.lit(1.0), F.col("p") * F.col("_k"))
    k = pairs.agg(F.count("*").alias("_k"))
    a = F.col("adjusted")
    sig = F.when(a <= 1e-4, "***").when(a <= 0.001, "**").when(a <= 0.01, "*").when(a <= 0.05, ".").otherwise("")
    return tests.join(F.broadcast(k)).withColumn("adjusted", adjusted).withColumn("sig", sig).drop("_k")


#: Tests of a block; blocks are what later minima are taken over.
BLOCK = 50_000


def benjamini_hochberg(tests: DataFrame, p: str = "p") -> DataFrame:
    """Adds fdr: the least of p * tests / rank over this and all larger p, 1 at most. Ranks and minima are found by blocks."""
    m = tests.agg(F.count("*").alias("_m"))
    r = numbered(tests, "_r", F.col(p)).join(F.broadcast(m)).withColumn("_v", F.col(p) * F.col("_m") / F.col("_r")).withColumn("_b", F.floor(F.col("_r") / BLOCK))
    least = r.groupBy("_b").agg(F.min("_v").alias("_l"))
    later = least.select("_b").alias("a").join(least.alias("b"), F.col("b._b") > F.col("a._b")).groupBy(F.col("a._b").alias("_b")).agg(F.min("b._l").alias("_l"))
    back = Window.partitionBy("_b").orderBy(F.desc("_r")).rowsBetween(Window.unboundedPreceding, 0)
    own = r.withColumn("_w", F.min("_v").over(back)).join(later, "_b", "left")
    return own.withColumn("fdr", F.least(F.lit(1.0), F.col("_w"), F.coalesce("_l", F.lit(1.0)))).drop("_m", "_r", "_v", "_b", "_l", "_w")


def indicators(counts: DataFrame, groups: DataFrame, permutations: int = 999, how: str = "indval") -> DataFrame:
    """(otu, grp, stat, p, fdr): the group that each OTU indicates best.

    "indval": sqrt(specificity * fidelity) with groups equalised; "phi": the group-equalised point-biserial correlation.
    """
    families = Families(groups.select(F.lit("").alias("fam"), "sample", "grp"), permutations)
    names, sizes = families.groups.get("", []), [int(m) for m in families.of[""][2]] if families.of else []
    chunk = permute.CHUNK  # goes with the tasks' code

    def best(own: pd.DataFrame) -> pd.DataFrame:
        """The OTUs of a bucket in a chunk of permutations: sums of all blocks, each permutation's best group."""
        width = min(chunk, permutations + 1 - int(own["chunk"].iloc[0]) * chunk)
        otus = sorted({o for some in own["otus"] for o in some})
        place = {o: i for i, o in enumerate(otus)}
        sums = np.zeros((3, len(otus), len(sizes), width))
        for some, b in zip(own["otus"], own["sums"]):
            sums[:, [place[o] for o in some]] += np.frombuffer(b).reshape(3, len(some), len(sizes), width)
        m = np.array(sizes, float)[:, None]
        k, (s, q, c) = len(sizes), sums
        mean = s / m
        if how == "phi":
            centre, square = mean.sum(1, keepdims=True) / k, (q / m).sum(1, keepdims=True) / k
            stat = (mean - centre) / np.sqrt(np.maximum(square - centre * centre, 1e-12) * (k - 1)) if k > 1 else np.full_like(mean, np.nan)
        else:
            stat = np.sqrt(mean / mean.sum(1, keepdims=True) * c / m)
        stat = np.where(c > 0, stat, -np.inf)  # a group without the OTU says nothing
        first = k - 1 - stat[:, ::-1, 0].argmax(1)  # the later name where two are alike
        return pd.DataFrame({"otu": otus, "chunk": own["chunk"].iloc[0], "grp": [names[i] for i in first], "best": list(stat.max(1))})

    sums = families.table_sums(counts.select("otu", "sample", "n"))
    chunks = materialise(sums.groupBy("bucket", "chunk").applyInPandas(best, "otu string, chunk long, grp string, best array<double>"), "chunks")
    real = chunks.where("chunk = 0").select("otu", "grp", F.get("best", F.lit(0)).alias("real"))
    ge = F.size(F.filter("best", lambda x: x >= F.col("real") - 1e-12))
    # the real labels are permutation 0, which always counts
    tests = chunks.select("otu", "best").join(real, "otu").groupBy("otu", "grp", "real").agg((F.sum(ge) / (F.lit(permutations) + 1)).alias("p"))
    return benjamini_hochberg(tests.select("otu", "grp", F.col("real").alias("stat"), "p"))


def hellinger(counts: DataFrame) -> DataFrame:
    """Euclidean distance of the square roots of shares."""
    t = counts.groupBy("sample").agg(F.sum("n").alias("t"))
    h = counts.join(t, "sample").select("otu", "sample", F.sqrt(F.col("n") / F.col("t")).alias("n"))
    return from_shared(h, shared(h, lambda a, b: a * b), F.sum(F.col("n") * F.col("n")), lambda x, a, b: F.sqrt(F.greatest(a + b - 2 * x, F.lit(0.0))))


def ordination(counts: DataFrame, axes: int = 2) -> DataFrame:
    """(sample, axis1, ..): principal components of Hellinger-transformed counts, which are the principal coordinates of
    their distances. Each axis's largest score is positive."""
    return principal_coordinates(hellinger(counts), axes).select("sample", *[f"axis{i + 1}" for i in range(axes)])


def group_centres(scores: DataFrame, groups: DataFrame, axes: int = 2) -> DataFrame:
    """(grp, mean and standard deviation of each axis)."""
    j = scores.join(groups.where("grp is not null"), "sample")
    return j.groupBy("grp").agg(*[f(f"axis{i}").alias(f"{n}{i}") for i in range(1, axes + 1) for n, f in (("mean", F.avg), ("sd", F.stddev))])


def results_table(tests: dict[str, DataFrame]) -> DataFrame:
    """(test, df, f, r2, p, sig): the one-row results of named tests in one table, nulls where a test has no such value."""
    columns = {"df": "int", "f": "double", "r2": "double", "p": "double"}
    parts = [t.select(F.lit(name).alias("test"), *[(F.col(c) if c in t.columns else F.lit(None)).cast(k).alias(c) for c, k in columns.items()]) for name, t in tests.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("sig", stars(F.col("p")))
