import random

from pyspark.sql import functions as F

from sporemill.operators import classify, ecology, peaks
from sporemill.plans import pipelines


def community(spark):
    """Reads of four true sequences in two samples, with rare errors, a chimera and low-quality reads."""
    random.seed(11)
    truth = ["".join(random.choice("ACGT") for _ in range(160)) for _ in range(4)]
    rows, n = [], 0
    for i, t in enumerate(truth):
        for sample, k in (("s1", 40 - 8 * i), ("s2", 10 + 6 * i)):
            for j in range(k):
                s = t if j % 9 else t[:40] + random.choice("ACGT") + t[41:]
                rows.append((f"r{n}", sample, s, ("#" if j % 20 == 19 else "I") * len(s)))
                n += 1
    for j in range(4):
        s = truth[0][:80] + truth[1][80:]
        rows.append((f"c{j}", "s1", s, "I" * len(s)))
    return truth, rows, spark.createDataFrame(rows, "read_id string, sample string, seq string, qual string")


def test_reads_to_annotated_table(spark):
    truth, rows, good = community(spark)
    otus, counts = pipelines.cluster_reads(good)
    found = {r.otu: r.seq for r in otus.collect()}
    assert sorted(found.values()) == sorted(truth) and set(found) == {"OTU1", "OTU2", "OTU3", "OTU4"}
    got = {(found[r.otu], r["sample"]): r.n for r in counts.collect()}
    for i, t in enumerate(truth):
        assert got[t, "s1"] == 40 - 8 * i and got[t, "s2"] == 10 + 6 * i
    asvs, _, groups = pipelines.denoise_reads(good, min_size=6)
    assert sorted(r.seq for r in asvs.collect()) == sorted(truth) and groups.count() == 4
    ranks = [["k:F", "p:A", "c:X"], ["k:F", "p:A", "c:Y"], ["k:F", "p:B"]]
    ref = spark.createDataFrame([(f"ref{i}", r, truth[i]) for i, r in enumerate(ranks)], "ref string, ranks array<string>, seq string")
    tax, full = pipelines.annotated(otus, counts, ref)
    by = {found[r.otu]: r.taxonomy for r in tax.collect()}
    assert by[truth[0]] == "GS|100.0|ref0;k:F,p:A,c:X" and by[truth[2]] == "GS|100.0|ref2;k:F,p:B"
    assert full.count() == counts.count()
    closed, rest = pipelines.closed_reference(good, ref.select(F.col("ref").alias("id"), "seq"))
    assert {r.otu for r in closed.collect()} == {"ref0", "ref1", "ref2"} and truth[3] in {r.seq for r in rest.collect()}


def test_bootstrap_classifier(spark):
    random.seed(3)
    base = "".join(random.choice("ACGT") for _ in range(200))
    other = "".join(random.choice("ACGT") for _ in range(200))
    tail = base[:150] + "".join(random.choice("ACGT") for _ in range(50))
    ref = spark.createDataFrame([("a", ["k:F", "p:A", "c:X"], base), ("b", ["k:F", "p:A", "c:Y"], tail), ("c", ["k:G"], other)], "ref string, ranks array<string>, seq string")
    q = spark.createDataFrame([("same", base), ("shared", base[:140]), ("none", "A" * 100), ("short", "ACG")], "otu string, seq string")
    got = {r.otu: (r.score, r.ranks) for r in classify.sintax(q, ref, 0.8).collect()}
    assert got["same"][1][:2] == ["k:F", "p:A"] and got["same"][0] >= 0.8
    assert got["shared"][1][:2] == ["k:F", "p:A"] and got["none"] == (0.0, []) and got["short"] == (0.0, [])


def test_peaks(spark):
    lengths = [100] * 30 + [101] * 20 + [140] * 25 + [160] * 5
    df = spark.createDataFrame([(str(i), "c", n) for i, n in enumerate(lengths)], "read_id string, cluster string, length int")
    got = peaks.split_by_length(df).groupBy("center").count().collect()
    assert {(r.center, r["count"]) for r in got} == {(100, 50), (140, 30)}


def test_raup_crick_and_ordination(spark):
    rows = [(f"o{i}", s, 1 + i) for s in ("a", "b") for i in range(5)] + [(f"o{i}", s, 2) for s in ("c", "d") for i in range(5, 12)]
    c = spark.createDataFrame(rows, "otu string, sample string, n long")
    d = {(r.s1, r.s2): r.d for r in ecology.raup_crick(c, 99).collect()}
    assert d["a", "b"] < 0.2 and d["a", "c"] == 1.0 and len(d) == 6
    o = {r["sample"]: r.axis1 for r in ecology.ordination(c).collect()}
    assert abs(o["a"] - o["b"]) < 1e-9 and abs(o["a"] - o["c"]) > 0.1
    g = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y"), ("d", "y")], "sample string, grp string")
    assert ecology.group_centres(ecology.ordination(c), g).count() == 2


def test_inferred_variants_run(spark):
    truth, rows, good = community(spark)
    few = spark.createDataFrame([(f"x{i}", "few", truth[0], "I" * 160) for i in range(9)], good.schema)
    run = pipelines.infer_reads(good.unionByName(few), identity=0.97)
    found = {r.otu: r.seq for r in run["variants"].collect()}
    assert sorted(found.values()) == sorted(truth)
    sizes = [r["size"] for r in run["variants"].orderBy(F.length("otu"), "otu").collect()]
    assert set(found) == {"ASV1", "ASV2", "ASV3", "ASV4"} and sizes == sorted(sizes, reverse=True)
    got = {(found[r.otu], r["sample"]): r.n for r in run["counts"].collect()}
    assert got[truth[0], "few"] == 9 and all(got[t, "s2"] == 10 + 6 * i for i, t in enumerate(truth))
    assert {r["sample"] for r in run["inferred"].select("sample").distinct().collect()} == {"s1", "s2"}
    assert len({r.otu for r in run["members"].collect()}) == run["otus"].count() == 4 and run["members"].count() == 4
    assert run["otu_counts"].count() == run["counts"].count()
