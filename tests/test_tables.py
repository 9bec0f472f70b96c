import random

import numpy as np
from pyspark.sql import functions as F

from sporemill.functions import seq
from sporemill.operators import ecology, refdb, table, taxonomy
from sporemill.sources import scans, sinks


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_sequence_expressions(spark):
    s = F.lit("ACGTRYNN")
    assert one(spark, seq.reverse_complement(seq.reverse_complement(s))) == "ACGTRYNN"
    assert one(spark, seq.strip_padding(s)[0]) == "ACGTRY"
    assert one(spark, seq.average_quality(F.lit("5555"))) == 20.0
    assert one(spark, seq.sample_of(F.lit("R_1;barcodelabel=x;size=2"))) == "x"
    assert one(spark, seq.index_of(F.lit("M:1:N:0:ACGT"))) == "ACGT" and one(spark, seq.index_of(F.lit("M:1:12"))) is None
    assert one(spark, seq.wrap(F.lit("A" * 161))).count("\n") == 2
    assert one(spark, seq.to_ascii(F.lit("Müller é ½"))) == "Muller e 1/2"
    assert one(spark, seq.human_size(F.lit(1536))) == "1.5 KB"


def test_wide_round_trip(spark, tmp_path):
    c = spark.createDataFrame([("OTU10", "s1", 3), ("OTU2", "s10", 4), ("OTU2", "s2", 1)], "otu string, sample string, n long")
    t = spark.createDataFrame([("OTU2", "k:F")], "otu string, taxonomy string")
    w = sinks.wide_with_taxonomy(c, t)
    assert w.columns == ["#OTU ID", "s1", "s2", "s10", "Taxonomy"] and [r[0] for r in w.collect()] == ["OTU2", "OTU10"]
    sinks.write_wide(c, f"{tmp_path}/w", t)
    back, tax = table.from_wide(spark.read.option("header", True).option("sep", "\t").csv(f"{tmp_path}/w"), "#OTU ID", "Taxonomy")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, c.collect())) and tax.count() == 2


def test_consensus(spark):
    a = spark.createDataFrame(
        [("1", 0.99, "r1", False, ["k:F", "p:A"]), ("2", 0.95, "r2", False, ["k:F"]), ("3", 1.0, "r3", False, ["k:F", "p:A", "c:X"]), ("4", 1.0, "r4", True, ["k:F", "p:B"]), ("5", 0.9, "r5", False, ["k:F"])],
        "otu string, pident double, ref string, lca boolean, ranks array<string>",
    )
    c = spark.createDataFrame(
        [("1", 0.9, "S", ["k:F", "p:A", "c:X"]), ("2", 0.8, "S", ["k:F", "p:Q"]), ("3", 0.8, "S", ["k:F"]), ("4", 0.9, "U", ["k:F", "p:A", "c:Y"])], "otu string, score double, method string, ranks array<string>"
    )
    got = {r.otu: r.taxonomy for r in taxonomy.consensus(a, c).collect()}
    assert got == {
        "1": "GS|99.0|r1;k:F,p:A,c:X",
        "2": "SS|0.8000|r2;k:F,p:Q",
        "3": "GS|100.0|r3;k:F,p:A,c:X",
        "4": "GDL|100.0|r4;k:F",
        "5": "GS|90.0|r5;k:F",
    }
    u = spark.createDataFrame([("1", 0.9, ["k:F"]), ("2", 0.5, ["k:F", "p:A"])], "otu string, score double, ranks array<string>")
    s = spark.createDataFrame([("1", 0.9, ["k:G"]), ("2", 0.9, ["k:F"]), ("3", 0.7, ["k:F"])], "otu string, score double, ranks array<string>")
    assert {r.otu: r.method for r in taxonomy.best_classifier(u, s).collect()} == {"1": "U", "2": "U", "3": "S"}
    assert one(spark, taxonomy.scored_ranks(F.lit("k:F(1.0),p:A(0.93),c:X(0.5),o:Y(0.9)"))) == ["k:F", "p:A"]


def test_headers(spark):
    h = "Fusarium_sp|KF1|SH123|reps|k__Fungi;p__Ascomycota;c__X_Incertae;o__Hypo;f__Nec;g__Fusarium;s__Fusarium_oxysporum"
    assert one(spark, refdb.unite(F.lit(h))) == "KF1|SH123;tax=k:Fungi,p:Ascomycota,o:Hypo,f:Nec,g:Fusarium,s:Fusarium oxysporum"
    assert one(spark, refdb.unite(F.lit("x_y|k__Fungi"))) is None
    assert one(spark, refdb.rdp(F.lit("AB1 Genus bella (T); x\tLineage=Root;rootrank;Fungi;domain;Asco;phylum;Gen;genus"))) == "AB1;tax=k:Fungi,p:Asco,g:Gen,s:Genus bella"
    assert one(spark, refdb.pr2(F.lit("E1;tax=k:Euk,p:A_B-C,c:Foo_X,s:Foo_bar"))) == "E1;tax=k:Euk,p:A,s:Foo bar"
    x = spark.createDataFrame([("AC", "r1", ["k:F", "p:A", "c:X"]), ("AC", "r2", ["k:F", "p:A", "c:Y"]), ("AC", "r0", ["k:F"])], "seq string, ref string, ranks array<string>")
    assert refdb.dereplicate(x).first().ranks == ["k:F", "p:A", "c:X"] and refdb.dereplicate(x, True).first().ranks == ["k:F", "p:A"]


def test_fastq(spark, tmp_path):
    text = "".join(f"@r{i} 1:N:0:ACGT\n{'ACGT' * 5}\n+\n{'@' + 'I' * 19}\n" for i in range(2000)) + "@bad\nACG\n+\nI\n"
    (tmp_path / "S1_ACGT_L001_R1_001.fastq").write_text(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10k")
    try:
        r = scans.folder_names(scans.fastq(spark, f"{tmp_path}/*.fastq"))
        assert r.where("reason is null").count() == 2000 and r.where("reason = 'malformed'").count() == 1
        last = r.where("read_id = 'r1999'").first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert (last.rec_no, last.seq, last.qual, last["sample"], last.i5) == (1999, "ACGT" * 5, "@" + "I" * 19, "S1", "ACGT")
    sinks.write_fastq(r.select("read_id", "sample", "seq", "qual"), f"{tmp_path}/out")
    assert scans.fastq(spark, f"{tmp_path}/out").where("reason is null").count() == 2001 - 1


def test_statistics_against_numpy(spark):
    random.seed(4)
    samples, otus = [f"s{i}" for i in range(8)], [f"o{i}" for i in range(12)]
    m = np.array([[random.choice([0, 0, random.randint(1, 50)]) for _ in otus] for _ in samples])
    m[:, 0] += 1
    m[0] += 1  # every OTU occurs
    c = spark.createDataFrame([(o, s, int(m[i, j])) for i, s in enumerate(samples) for j, o in enumerate(otus) if m[i, j]], "otu string, sample string, n long")
    bc = {(r.s1, r.s2): r.d for r in ecology.bray_curtis(c).collect()}
    log = np.log(m + 1.0)
    clr = log - log.mean(1, keepdims=True)
    ait = {(r.s1, r.s2): r.d for r in ecology.aitchison(c).collect()}
    for i in range(8):
        for j in range(i + 1, 8):
            assert np.isclose(bc[samples[i], samples[j]], 1 - 2 * np.minimum(m[i], m[j]).sum() / (m[i].sum() + m[j].sum()))
            assert np.isclose(ait[samples[i], samples[j]], np.linalg.norm(clr[i] - clr[j]))
    g = spark.createDataFrame([(s, "AB"[i % 2]) for i, s in enumerate(samples)], "sample string, grp string")
    got = ecology.permanova(ecology.aitchison(c), g, 49).first()
    x = clr - clr.mean(0)
    within = sum(((x[k::2] - x[k::2].mean(0)) ** 2).sum() for k in (0, 1))
    total = (x**2).sum()
    assert np.isclose(got.f, (total - within) / 1 / (within / 6)) and np.isclose(got.r2, 1 - within / total) and 0 < got.p <= 1
    z = {r["sample"]: r.z for r in ecology.centroid_distances(ecology.aitchison(c), g).collect()}
    for i, s in enumerate(samples):
        assert np.isclose(z[s], np.linalg.norm(x[i] - x[i % 2 :: 2].mean(0)))


def test_metadata_rows_have_no_column_an_otu(spark):
    counts = spark.createDataFrame([("OTU10", "a", 3), ("OTU2", "a", 1), ("OTU2", "a", 4), ("OTU2", "b", 7)], "otu string, sample string, n long")
    meta = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "sample string, treatment string")
    wide, header = sinks.metadata_by_otu(meta, counts)
    assert wide.columns == ["sample", "treatment", "values"]
    assert {tuple(r) for r in header.collect()} == {("OTU2", 1), ("OTU10", 2)}
    assert {(r["sample"], r.treatment, tuple(r["values"])) for r in wide.collect()} == {("a", "x", (5, 3)), ("b", "y", (7, 0))}
