"""Chimeras, bimera votes, seeds, whole demultiplexing runs and sinks against brute force."""

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sporemill.functions.order import numbered
from sporemill.functions.scratch import materialise, scratch_path, scratch_scope
from sporemill.operators import cluster, demux, ecology, peaks, refdb, simjoin
from sporemill.plans import pipelines
from sporemill.sources import scans, sinks

F1, R1 = "GTGAATCATCGAATCTTTG", "TCCTCCGCTTATTGATATGC"


def spell(rng, n):
    return "".join(rng.choice("ACGT") for _ in range(n))


def brute_chimeras(rows, skew=2.0, min_gain=3, most=1):
    """The rule, place by place, the most abundant first."""
    bad = set()
    for i, q, size in sorted(rows, key=lambda r: -r[2]):
        parents = [p for j, p, n in rows if n >= skew * size and j not in bad and j != i]
        n = len(q)
        left = [[sum(a != b for a, b in zip(q[:c], p[:c])) + max(0, c - len(p)) for p in parents] for c in range(n + 1)]
        right = [[sum(a != b for a, b in zip(q[c:][::-1], p[::-1])) + max(0, n - c - len(p)) for p in parents] for c in range(n + 1)]
        if len(parents) > 1:
            two = min(min(x) + min(y) for x, y in zip(left, right))
            one = min(min(left[n]), min(right[0]))
            if two <= most and one - two >= min_gain:
                bad.add(i)
    return bad


def test_chimeras_against_brute_force(spark):
    rng = random.Random(5)
    start = spell(rng, 30)  # all begin alike, as marker genes do
    truth = [start + spell(rng, 90) for _ in range(14)]
    rows = [(f"t{i}", t, 4000 - 10 * i) for i, t in enumerate(truth)]
    for k in range(12):
        a, b = rng.sample(truth, 2)
        c = rng.randrange(45, 100)
        q = a[:c] + b[c:]
        if k % 3 == 1:
            q = q[:70] + ("A" if q[70] != "A" else "C") + q[71:]  # a read error
        if k % 3 == 2:
            q = a[:c] + b[c + 1 :]  # a base is lost where they meet
        rows.append((f"c{k}", q, 900 - k))
        rows.append((f"d{k}", q[:60] + truth[k][60:], 40 + k))  # its parent may be a chimera
    rows += [(f"n{k}", truth[k][:50] + ("A" if truth[k][50] != "A" else "C") + truth[k][51:], 30) for k in range(6)]
    got = {r.id for r in cluster.chimeras(spark.createDataFrame(rows, "id string, seq string, size long")).where("chimera").collect()}
    assert got == brute_chimeras(rows) and len(got) > 12
    reference = spark.createDataFrame([(f"t{i}", t) for i, t in enumerate(truth)], "id string, seq string")
    queries = spark.createDataFrame([r for r in rows if r[0][0] in "cn"], "id string, seq string, size long")
    found = {r.id for r in cluster.chimeras(queries, reference, min_divergence=1.0).where("chimera").collect()}
    assert found == {f"c{k}" for k in range(12)} & got


def test_bimera_votes(spark):
    rng = random.Random(6)
    a, b, c = (spell(rng, 80) for _ in range(3))
    x, y = a[:40] + b[40:], b[:40] + c[40:]
    rows = [(s, q, n) for s in ("s1", "s2", "s3") for q, n in ((a, 100), (b, 90), (x, 10))] + [("s1", c, 80), ("s1", y, 8), ("s2", y, 8), ("s3", y, 500)]
    df = spark.createDataFrame(rows, "sample string, seq string, n long")
    left = lambda how: sorted((r["sample"], r.seq) for r in cluster.bimeras(df, how).collect())
    without = lambda *gone: sorted((s, q) for s, q, _ in rows if (s, q) not in gone and q not in gone)
    assert left("consensus") == without(x)  # y is flagged in one of its three samples
    assert left("per-sample") == without(x, ("s1", y))
    assert left("pooled") == without(x)  # over all samples y is the most abundant


def test_numbers_and_scopes(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    assert {(r.k, r.n) for r in numbered(df, "n", F.asc("k")).collect()} == {(i, i + 1) for i in range(1000)}
    with scratch_scope(spark):
        path = scratch_path(spark, "x")
        spark.range(3).write.parquet(path)
        assert materialise(spark.range(5), "y").count() == 5
        assert Path(path.removeprefix("file:")).exists()
    assert not Path(path.removeprefix("file:")).exists()


def test_seed_finds_distant_pairs(spark):
    """Pairs of 75 % identity: what the chosen seed finds against all pairs."""
    rng = random.Random(8)
    rows = []
    for i in range(60):
        t = spell(rng, 240)
        q = "".join(rng.choice("ACGT") if rng.random() < 0.24 else x for x in t)
        rows.append((f"q{i}", q, f"t{i}", t))
    q = spark.createDataFrame([r[:2] for r in rows], "id string, seq string")
    t = spark.createDataFrame([r[2:] for r in rows], "id string, seq string")
    every = q.select(F.col("id").alias("query"), F.col("seq").alias("s1")).join(t.select(F.col("id").alias("target"), F.col("seq").alias("s2")))
    want = {(r.query, r.target) for r in every.where(1 - F.levenshtein("s1", "s2") / F.greatest(F.length("s1"), F.length("s2")) >= 0.75).collect()}
    got = {(r.query, r.target) for r in simjoin.similar(q, t, 0.75, None).collect()}
    assert len(want) > 30 and got <= want and len(got) >= 0.99 * len(want)
    assert simjoin.seed(250, 0.97) == 12 and simjoin.seed(250, 0.75) is None


def test_width_of_peaks(spark):
    rows = [("c", n, 20) for n in (100, 101, 102, 103)] + [("c", 140, 50), ("c", 141, 5), ("c", 180, 40), ("c", 181, 30), ("c", 182, 30), ("c", 179, 25)]
    h = spark.createDataFrame(rows, "cluster string, length int, reads long")
    assert {r.center for r in peaks.peaks(h, width=4).collect()} == {100, 180}
    assert {r.center for r in peaks.peaks(h).collect()} == {100, 140, 180}


def reads_of(rng, n=12):
    return [(f"r{i}", spell(rng, 90)) for i in range(n)]


def q_of(s):
    return "I" * len(s)


def test_whole_runs(spark):
    rng = random.Random(9)
    cores = reads_of(rng)
    barcodes = [("a", "ACGTACGTAC"), ("b", "TTGGCCAATT")]
    end = demux.revcomp(R1)
    whole = [(i, F1 + c + end) for i, c in cores]
    code = lambda k: barcodes[k % 2][1]
    # X1: single reads
    raw = spark.createDataFrame([(i, code(k) + s, q_of(code(k) + s)) for k, (i, s) in enumerate(whole)] + [("none", "A" * 120, q_of("A" * 120))], "read_id string, seq string, qual string")
    got = pipelines.single_reads(raw, F1, R1, barcodes, least=40)
    assert {(r.read_id, r["sample"], r.seq) for r in got["good"].collect()} == {(i, "ab"[k % 2], c) for k, (i, c) in enumerate(cores)}
    assert {r.reason: r.reads for r in got["counters"].collect()} == {None: 12, "no_barcode": 1} and {r["sample"]: r.reads for r in got["samples"].collect()} == {"a": 6, "b": 6}
    # compat: after N-prefixed barcodes the N stay uncounted
    one = lambda **o: pipelines.single_reads(spark.createDataFrame([("x", "GG" + code(0) + "TT" + whole[0][1], q_of("GG" + code(0) + "TT" + whole[0][1]))], "read_id string, seq string, qual string"), F1, R1, [("a", "NN" + code(0))], least=40, **o)["good"].first()
    assert one().seq == one(compat=True).seq == cores[0][1]
    mates = lambda f, r: [(i, (f(k) + s[:100], q_of(f(k) + s[:100])), (r(k) + demux.revcomp(s)[:80], q_of(r(k) + demux.revcomp(s)[:80]))) for k, (i, s) in enumerate(whole)]
    kind = "read_id string, r1 struct<seq:string,qual:string>, r2 struct<seq:string,qual:string>"
    expected = {(i, c) for i, c in cores}
    # X2: barcodes in both mates
    sheet = spark.createDataFrame([("s1", "a", "b"), ("s2", "b", "a")], "sample_id string, for_label string, rev_label string")
    got = pipelines.barcoded_pairs(spark.createDataFrame(mates(code, lambda k: code(k + 1)), kind), sheet, barcodes, barcodes, F1, R1, min_length=40)
    assert {(r.read_id, r.seq) for r in got["good"].collect()} == expected and {r["sample"] for r in got["samples"].collect()} == {"s1", "s2"}
    # X4: a read of its own for the index
    rows = [(i, a, b, code(k)) for k, (i, a, b) in enumerate(mates(lambda k: "", lambda k: ""))] + [("none", (whole[0][1], q_of(whole[0][1])), (demux.revcomp(whole[0][1]), q_of(whole[0][1])), "G" * 10)]
    got = pipelines.indexed_pairs(spark.createDataFrame(rows, kind + ", index string"), barcodes, F1, R1, min_length=40)
    assert {(r.read_id, r.seq) for r in got["good"].collect()} == expected and {r.reason: r.reads for r in got["counters"].collect()} == {None: 12, "no_barcode": 1}
    # X5: consensus reads, every second one turned
    turned = [(i, demux.revcomp(s) if k % 2 else s) for k, (i, s) in enumerate(whole)]
    sam = spark.createDataFrame([(s, q_of(s), i, 0.99, k % 2, k % 2, 90, None) for k, (i, s) in enumerate(turned)], "seq string, qual string, zm string, rq double, bc_forward int, bc_reverse int, bq int, reason string")
    names = spark.createDataFrame([(0, "a"), (1, "b")], "pos int, label string")
    got = pipelines.consensus_reads(sam, names, F1, R1)
    assert {(r.read_id, r["sample"], r.seq) for r in got["good"].collect()} == {(i, "ab"[k % 2], s) for k, (i, s) in enumerate(whole)}
    # X6: folders of long reads
    long = spark.createDataFrame([(f"/d/run1/{'unclassified' if k == 3 else 'bc01'}/f.fastq", i, s, q_of(s), None) for k, (i, s) in enumerate(turned)], "source string, read_id string, seq string, qual string, reason string")
    got = pipelines.nanopore_reads(long, F1, R1, least=100)
    assert {(r.read_id, r["sample"], r.seq) for r in got["good"].collect()} == {(i, "run1::bc01", s) for k, (i, s) in enumerate(whole) if k != 3}


def test_folder_of_pairs(spark, tmp_path):
    """X3: two samples as FASTQ files of mates, one of them with mates in the other order."""
    rng = random.Random(10)
    expected = set()
    for sample in ("s1", "s2"):
        text = {"R1": "", "R2": ""}
        for i, c in reads_of(rng):
            s = F1 + c + demux.revcomp(R1)
            a, b = s[:100], demux.revcomp(s)[:80]
            if sample == "s2":
                a, b = b, a
            text["R1"] += f"@{i}\n{a}\n+\n{q_of(a)}\n"
            text["R2"] += f"@{i}\n{b}\n+\n{q_of(b)}\n"
            expected.add((sample, i, c))
        for mate, t in text.items():
            (tmp_path / f"{sample}_ACGTAC-TTGGCC_L001_{mate}_001.fastq").write_text(t)
    got = pipelines.folder_of_pairs(scans.fastq(spark, f"{tmp_path}/*_R1_*"), scans.fastq(spark, f"{tmp_path}/*_R2_*"), F1, R1, min_length=40)
    assert {(r["sample"], r.read_id, r.seq) for r in got["good"].collect()} == expected
    sheet = pipelines.submission(got["good"], spark.createDataFrame([("SAM1", "s1", "P", "H")], "accession string, name string, project string, host string"), {"platform": "X"}, f"{tmp_path}/out")
    assert {(r["sample"], r.accession) for r in sheet.collect()} == {("s1", "SAM1"), ("s2", None)} and scans.fastq(spark, f"{tmp_path}/out/sample=*").count() == 24


def test_pre_denoised_clusters(spark):
    rng = random.Random(11)
    t = [spell(rng, 120) for _ in range(3)]
    rows = [(f"r{i}-{j}-{k}", "s", s[: 10 + j] + ("A" if s[10 + j] != "A" else "C") + s[11 + j :] if j else s, "I" * 120) for i, s in enumerate(t) for j in range(4) for k in range(9 - 2 * j)]
    good = spark.createDataFrame(rows, "read_id string, sample string, seq string, qual string")
    otus, counts = pipelines.cluster_reads(good, pre_denoise=True)
    assert sorted(r.seq for r in otus.collect()) == sorted(t) and counts.agg(F.sum("n")).first()[0] == len(rows)


def test_biom_file(spark, tmp_path):
    counts = spark.createDataFrame([("o1", "a", 3), ("o2", "a", 1), ("o2", "b", 7)], "otu string, sample string, n long")
    ranks = spark.createDataFrame([("o1", ["k:F", 'p:"x"'])], "otu string, ranks array<string>")
    about = spark.createDataFrame([("a", "t1"), ("b", "t2")], "sample string, treatment string")
    sinks.write_biom(counts, ranks, about, f"{tmp_path}/biom")
    (file,) = Path(tmp_path / "biom").glob("part-*")
    doc = json.loads(file.read_text())
    assert doc["shape"] == [2, 2] and [r["id"] for r in doc["rows"]] == ["o1", "o2"] and doc["data"] == [[0, 0, 3], [1, 0, 1], [1, 1, 7]]
    assert doc["rows"][0]["metadata"]["taxonomy"] == ["k:F", 'p:"x"'] and doc["columns"][1]["metadata"] == {"treatment": "t2"}
    with pytest.raises(ValueError):
        sinks.write_biom(counts, ranks, about.where("sample = 'a'"), f"{tmp_path}/no")


def test_barcode_reference(spark):
    rng = random.Random(12)
    a, b = spell(rng, 100), spell(rng, 100)
    near = a[:50] + ("A" if a[50] != "A" else "C") + a[51:]
    rows = [("BOLD:X1", "i1", a, "Aus bus"), ("BOLD:X1", "i2", near, ""), ("BOLD:X1", "i3", b, ""), ("BOLD:X2", "i4", a, ""), ("BOLD:X2", "i5", b, "")]
    dump = spark.createDataFrame([(s, i, "AB1", k, "", "COI-5P", "Arthropoda", "Insecta", "", "", "", sp) for k, i, s, sp in rows], "nucleotides string, sequenceID string, genbank_accession string, bin_uri string, identification_provided_by string, marker_codes string, phylum_name string, class_name string, order_name string, family_name string, genus_name string, species_name string")
    got = {r.id: r.header for r in refdb.barcode_reference(dump).collect()}
    named = "k:Animalia,p:Arthropoda,c:Insecta"
    first = "i1" if a < near else "i2"
    assert got == {first: f"{first}|X1;tax={named},s:Aus bus", "i3": f"i3|X1;tax={named},s:Aus bus", "i4": f"i4|X2;tax={named}", "i5": f"i5|X2;tax={named}"}


def test_results_table(spark):
    a = spark.createDataFrame([(2, 3.5, 0.25, 0.001)], "df int, f double, r2 double, p double")
    b = spark.createDataFrame([(1.5, 0.04)], "f double, p double")
    got = {r.test: (r.df, r.f, r.r2, r.p, r.sig) for r in ecology.results_table({"x": a, "y": b}).collect()}
    assert got == {"x": (2, 3.5, 0.25, 0.001, "***"), "y": (None, 1.5, None, 0.04, "*")}


def test_strip_primers_at_the_first_base(spark):
    s = F1 + "ACCA" * 30 + demux.revcomp(R1)
    df = spark.createDataFrame([("x", s)], "id string, seq string")
    assert demux.strip_primers(df, F1, R1, keep="for").first().reason is None
    assert demux.strip_primers(df, F1, R1, keep="for", compat=True).first().reason == "NO_PRIMER_MATCH"
