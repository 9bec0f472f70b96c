import pytest

from sporemill.operators import reads


def test_filters(spark):
    p = spark.createDataFrame([(1, "a:N:0:ACGT", "a:N:0:ACGT"), (2, "a:N:0:ACGG", "a:N:0:ACGT"), (3, "a:1", "a:2")], "i int, title1 string, title2 string")
    assert sorted(r.i for r in reads.right_index(p, "ACGT").collect()) == [1, 3]
    r = spark.createDataFrame([("a", "A" * 90, [5, 80]), ("b", "A" * 90, [5, 20]), ("c", "A" * 90, [-1, 80]), ("d", "A" * 10, [-1, 5]), ("e", "A" * 90, None)], "read_id string, seq string, primers array<int>")
    assert [x.read_id for x in reads.proper_reads(r, 50).collect()] == ["a"]
    assert sorted(x.read_id for x in reads.proper_reads(r, 50, partial=True).collect()) == ["a", "c"]
    report = spark.createDataFrame([("a", "NotBad", 90, "x"), ("b", "Chimeric", 90, "y"), ("c", "NotBad", 10, "z")], "read_id string, status string, length int, data string")
    assert [x.data for x in reads.not_bad(r, report, 50).collect()] == ["x"]


def test_records(spark):
    a = spark.createDataFrame([("x", "ACGTAC"), ("y", "AC")], "id string, seq string")
    gone = spark.createDataFrame([("y",)], "id string")
    assert [tuple(r) for r in reads.trim_three_prime(a, 4, gone).collect()] == [("x", "ACGT")]
    both = reads.union_of(a, a.select("seq", "id"))
    assert both.count() == 4 and reads.distinct_ids(a) is a
    with pytest.raises(ValueError):
        reads.distinct_ids(both)


def test_quality_of_odd_reads(spark):
    q = spark.createDataFrame([("a", None), ("b", ""), ("c", "5"), ("d", "55")], "read_id string, qual string").withColumn("seq", reads.F.lit("ACGT"))
    got = {r.read_id: r.e for r in q.select("read_id", reads.s.expected_errors(reads.F.col("qual")).alias("e")).collect()}
    assert got["a"] is None and got["b"] == 0 and abs(got["c"] - 0.01) < 1e-12 and abs(got["d"] - 0.02) < 1e-12
    assert sorted(r.read_id for r in reads.max_errors(q, 0.015).collect()) == ["b", "c"]


def test_relabel_is_one_sequence_over_partitions(spark):
    seqs = spark.createDataFrame([(f"S{i:03d}", i % 7) for i in range(200)], "seq string, size int").repartition(5)
    got = {r.seq: int(r.id[1:]) for r in reads.relabel(seqs, "A").collect()}
    order = sorted(got, key=lambda x: (-(int(x[1:]) % 7), x))
    assert [got[x] for x in order] == list(range(1, 201))
