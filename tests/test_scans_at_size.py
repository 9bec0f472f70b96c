"""Steps that must not be done twice, per base or per row in Python, and text that must not be written as it is."""

import random
from pathlib import Path

import pyarrow as pa
import pytest

from sporemill.functions import seq
from sporemill.operators import demux
from sporemill.plans import queries  # noqa: F401  (first: it registers the others)
from sporemill.plans import read_queries
from sporemill.sources import scans, sinks

SMALL = "/root/testdata/sf0.001"


def quals(*more):
    random.seed(1)
    return [None, "", *["".join(chr(random.randint(43, 126)) for _ in range(random.randint(0, 9))) for _ in range(300)], *more]


@pytest.mark.parametrize("some", [quals(), quals("!#é"), [], [None]])
def test_batches_of_qualities(some):
    for a in (pa.array(some, pa.string()), pa.array(["zz", *some, "x"], pa.string())[1 : len(some) + 1]):
        scores = seq.scores_of(a).to_pylist()
        assert scores == [None if q is None else " ".join(str(ord(c) - 33) for c in q) for q in some]
        lines = [None if s is None else s.replace(" ", " \n") + "\n" for s in scores]
        assert seq.letters_of(pa.array(lines, pa.string())).to_pylist() == some
        for got, q in zip(seq.sum_errors(a).to_pylist(), some):
            assert got is None if q is None else got == pytest.approx(sum(10 ** (-(ord(c) - 33) / 10) for c in q))


def test_index_reads_of_few_kinds_are_broadcast(spark):
    reads = spark.createDataFrame([("a", "ACGT"), ("b", "ACGA"), ("c", None), ("d", "TTTT")], "read_id string, index string")
    out = demux.match_index(reads, [("S1", "ACGT")], 1)
    assert {r.read_id: r.barcode and r.barcode.label for r in out.collect()} == {"a": "S1", "b": "S1", "c": None, "d": None}
    assert "ResolvedHint (strategy=broadcast)" in out._jdf.queryExecution().analyzed().toString()


def test_text_is_written_packed(spark, tmp_path):
    rows = spark.createDataFrame([("a", "ACGTACGT", 3), ("b", "GG", 1)], "id string, seq string, size long")
    sinks.write_fasta(rows, f"{tmp_path}/f", size="size", width=4)
    read_queries.text_file(rows.select("seq"), f"{tmp_path}/t")
    for name in "ft":
        parts = list(Path(f"{tmp_path}/{name}").glob("part-*"))
        assert parts and all(p.suffix == ".gz" for p in parts)
    assert {(r.id, r.seq) for r in scans.fasta(spark, f"{tmp_path}/f").collect()} == {("a;size=3;", "ACGTACGT"), ("b;size=1;", "GG")}


def test_fasta_bodies(spark, tmp_path):
    Path(f"{tmp_path}/x.fa").write_bytes(b">a one\r\nAC GT\r\nTT\r\n>b\n>c two\nGG\n\tC\n")
    assert [(r.id, r.seq) for r in scans.fasta(spark, f"{tmp_path}/x.fa").collect()] == [("a", "ACGTTT"), ("b", ""), ("c", "GGC")]


def test_uniques_are_made_once(spark):
    assert "lineitem" not in read_queries.trim_ends(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()


def test_records_by_sample_need_no_numbers(spark, monkeypatch):
    def none(*_):
        raise AssertionError("records were counted")

    monkeypatch.setattr(scans, "materialise", none)
    assert read_queries.fastq_by_sample(spark, SMALL).count() == 10


def test_sequences_and_scores_meet_compressed(spark, tmp_path, monkeypatch):
    """As by a join of the texts, with ids that repeat or lack on a side; the texts are no column of a shuffle."""
    from sporemill.functions import packed

    ids = [f"r{i}" for i in range(500)] + ["r7", "r8", "only"]
    (tmp_path / "a.fasta").write_text("".join(f">{i} x\n{'ACGT' * (n % 9)}\nGG{n}\n" for n, i in enumerate(ids)))
    (tmp_path / "a.qual").write_text("".join(f">{i}\n{' '.join(['40', '7'] * (n % 5 + 1))}\n" for n, i in enumerate([*ids[:-1], "r7", "other"])))
    want = sorted((i, "ACGT" * (n % 9) + f"GG{n}", "I(" * (m % 5 + 1)) for n, i in enumerate(ids) for m, j in enumerate([*ids[:-1], "r7", "other"]) if i == j)
    for size in (packed.GATHERED, 300):
        monkeypatch.setattr(packed, "GATHERED", size)
        df = scans.fasta_with_qual(spark, str(tmp_path / "a.fasta"), str(tmp_path / "a.qual"))
        assert sorted((r.id, r.seq, r.qual) for r in df.collect()) == want
    shuffles = [x for x in df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines() if "Exchange" in x]
    assert len(shuffles) == 2 and all("part" in x for x in shuffles)
    (tmp_path / "e.qual").write_text("")
    assert scans.fasta_with_qual(spark, str(tmp_path / "a.fasta"), str(tmp_path / "e.qual")).count() == 0


def test_reads_of_references_are_spelt_once(spark):
    """Both ways of dereplication read one table of records; numbers of ids come from the rows and not from their text."""
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "md5(" not in plan(queries.QUERIES["dereplicate_references"](spark, SMALL))
    c = read_queries.cores(spark, SMALL)
    assert "split(" not in plan(c)
    for r in c.limit(200).collect():
        assert [r.o, r.l, r.p, r.s] == [int(x) for x in r.read_id.split("_")[1:]] and r.core == r.seq[27:-20] and r.bc == r.seq[:8]
