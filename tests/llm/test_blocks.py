"""Centroid clustering, hard negatives and packing: against brute force, SQL and the library's own ids, and on odd rows."""

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from oracle import assert_equal, views
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sporemill.llm import centroids, negatives, packing, queries

SF = "/root/testdata/sf0.001"
FILE = public_tokenizers.path("byte_bpe_50k.json")
VECTORS = "vec_id long, embedding array<double>, label int"


@pytest.fixture(scope="module")
def duck():
    return views(SF)


@pytest.mark.parametrize("name", ["op11_centroids", "op12_hard_negatives"])
def test_query_equals_sql(spark, duck, name):
    assert_equal(queries.QUERIES[name](spark, SF), duck, queries.ORACLE_SQL[name])


def clashing(df):
    for name in ("row", "cluster", "q", "v", "score", "slot", "rank", "n", "id", "dim", "part", "text_cut", "piece", "length", "packer", "bin"):
        df = df.withColumn(name, F.lit(1))
    return df


def odd_vectors(spark, dim, seed=5):
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.standard_normal(dim) / 3).tolist(), int(rng.integers(0, 4))) for i in range(300)]
    hot = (rng.standard_normal(dim) / 3).tolist()
    rows += [(1000 + i, hot, i % 2) for i in range(150)]  # one vector many times
    rows += [(7, rows[7][1], 2), (7, rows[7][1], 2), (8, rows[9][1], rows[8][2])]  # repeated rows, and an id of two vectors
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.5] * (dim - 1), 1), (2003, [math.nan] + [0.1] * (dim - 1), 1), (2004, [math.inf] * dim, 1), (2005, [None] + [0.1] * (dim - 1), 1), (2006, [0.0] * dim, 3), (2050, [-1.5] * dim, 0), (2100, hot, None)]
    rows += [(None, [0.25] * dim, 1)]
    return clashing(spark.createDataFrame(rows, VECTORS)), rows


def sound(v, dim):
    return v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)


def test_clusters_equal_plain_rounds(spark):
    dim = 64
    df, rows = odd_vectors(spark, dim)
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v, _ in rows if sound(v, dim)]
    sha = lambda i: "~" if i is None else hashlib.sha256(f"2:{i}".encode()).hexdigest()
    centres = [q for _, q in sorted(kept, key=lambda r: (sha(r[0]), r[1]))[:12]]
    near = lambda q: min((sum((a - b) ** 2 for a, b in zip(q, c)), n) for n, c in enumerate(centres))
    for _ in range(3):
        member = [near(q)[1] for _, q in kept]
        centres = [[sum(col) // len(col) for col in zip(*own)] if (own := [q for (_, q), m in zip(kept, member) if m == n]) else c for n, c in enumerate(centres)]
    want = [(i, near(q)[1], near(q)[0]) for i, q in kept]
    got = centroids.cluster_vectors(df, k=12, rounds=3).collect()
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=str) == sorted(want, key=str)
    for r in got:
        assert r.centroid == centres[r.cluster] and r.centroid_sha256 == hashlib.sha256(",".join(map(str, centres[r.cluster])).encode()).hexdigest()
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster) and r.inertia == sum(d for *_, d in want)


def test_few_and_no_and_huge_vectors(spark):
    few = spark.createDataFrame([(1, [0.1] * 64, None), (2, [0.3] * 64, 1)], VECTORS)
    assert sorted((r.vec_id, r.distance) for r in centroids.cluster_vectors(few).collect()) == [(1, 0), (2, 0)]
    assert centroids.cluster_vectors(few.limit(0)).count() == 0
    assert centroids.cluster_vectors(spark.createDataFrame([(1, None, 1), (2, [1.0], 1)], VECTORS)).count() == 0
    with pytest.raises(Exception, match="no place in a long"):
        centroids.cluster_vectors(spark.createDataFrame([(1, [1e30] * 64, 1)], VECTORS)).count()


def test_blocks_do_not_matter_to_clusters():
    rng = np.random.default_rng(2)
    q, c = rng.integers(-300, 300, (500, 6)), rng.integers(-300, 300, (7, 6))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(500)), pa.array(q.tolist())], names=["row", "q"])
    (block,) = centroids.blocks_of(6)([batch.slice(0, 200), batch.slice(200)])
    ((rows, values, places),) = centroids.opened([block], 6)
    best, distance = centroids.nearest(values, places, c)
    plain = ((q[:, None] - c[None]) ** 2).sum(2)
    assert (rows == np.arange(500)).all() and (best == plain.argmin(1)).all() and (distance == plain.min(1)).all()


def mined(rows, dim, every=10):
    kept = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, a, y in kept:
        if i % every:
            continue
        score = [(-sum(p * q for p, q in zip(a, b)), j, z) for j, b, z in kept if len(b) == len(a)]
        for s, j, _ in sorted(x for x in score if x[2] == y and x[1] != i)[:5]:
            ok = sorted(x for x in score if x[2] != y and 50 * -s <= 100 * -x[0] <= 95 * -s)[:3]
            out += [(i, j, n + 1, x[1], -s, -x[0]) for n, x in enumerate(ok)]
    return sorted(out)


@pytest.mark.parametrize("exact", [negatives.EXACT, 1])
def test_hard_negatives_equal_plain_search(spark, monkeypatch, exact):
    for name, value in (("ANCHORS", 11), ("ROWS", 60), ("EXACT", exact)):
        monkeypatch.setattr(negatives, name, value)
    df, rows = odd_vectors(spark, 5)
    got = negatives.hard_negatives(df, F.col("vec_id") % 10 == 0)
    want = mined(rows, 5)
    assert len(want) > 50 and sorted(tuple(r) for r in got.collect()) == want
    assert got.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"), ("positive_score", "bigint"), ("negative_score", "bigint")]
    assert negatives.hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert negatives.hard_negatives(df, F.lit(False)).count() == 0


def test_scores_too_large_for_windows_are_an_error(spark):
    with pytest.raises(ValueError, match="must stay below"):
        negatives.hard_negatives(spark.createDataFrame([(1, [1e9] * 4, 1)], VECTORS), F.lit(True))


def test_slots_keep_the_best_of_each():
    rng = np.random.default_rng(3)
    cell, score, ident = rng.integers(0, 9, 4000), rng.integers(0, 40, 4000), rng.permutation(4000)
    best = negatives.Slots(9, 3)
    for s in range(0, 4000, 333):
        best.add(cell[s : s + 333], score[s : s + 333], ident[s : s + 333])
    want = [(c, -s, i) for c in range(9) for s, i in sorted((-score[j], ident[j]) for j in np.flatnonzero(cell == c))[:3]]
    assert list(zip(best.cell, best.score, best.id)) == want


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def test_ids_are_the_librarys(library):
    random.seed(4)
    bits = [*"abcDE12.,!'<|>\t\n\x0b\x0c\r  \x1c\x1d\x85\xa0   ​　﻿é中\0ßs't😀", "<|endoftext|>", "'ll", "  ", "\r\n", " don't", "naïve "]
    texts = ["".join(random.choices(bits, k=random.randint(0, 30))) for _ in range(8000)] + ["", " ", "a" * 5000, "x y " * 3000, "é" * 900 + " " + "7" * 900]
    got = packing.Encoder(FILE).texts(pa.array(texts, pa.large_string()))
    assert [g.tolist() for g in got] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def packing_docs(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(["the", "alpha", "Bé", "x1", "\n"]) for _ in range(rng.choice([1, 3, 30, 200])))) for i in range(400)]
    rows += [(400, None), (401, ""), (402, "word " * 9000), (None, "no id"), (403, "again"), (403, "again"), (404, "w " * 2047), (405, "w " * 2046)]
    return clashing(spark.createDataFrame(rows, "doc_id long, text string")), rows


def laid(rows, size):
    """Checks that sequences are gapless and at most ``size`` long, and gives how many there are."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_pieces_are_the_documents(spark, library):
    df, rows = packing_docs(spark)
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        first = len(ids) % 2048 or 2048
        starts = [0, *range(first, len(ids), 2048)] if len(ids) > 2048 else [0]
        want += [(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()), ids[a:b]) for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)]))]
    got = packing.pieces(df, FILE).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, r.ids) for r in got), key=str) == sorted(want, key=str)
    slim = packing.pieces(df, FILE, ids=False)
    assert slim.columns == packing.NAMES and sorted((tuple(r) for r in slim.collect()), key=str) == sorted((tuple(r)[:-1] for r in got), key=str)
    assert packing.pieces(df.limit(0), FILE).count() == 0


def plain_best_fit(lengths, size, most):
    """The rule by a list of open bins: (bin, offset) of each piece; which of equally full bins is taken, the newest of them by its last piece."""
    bins, out, made = [], [], 0  # (free, time, number)
    for t, n in enumerate(lengths):
        fit = [b for b in bins if b[0] >= n]
        if fit:
            b = min(fit, key=lambda b: (b[0], -b[1]))
            bins.remove(b)
        else:
            if len(bins) == most:
                bins.remove(min(bins, key=lambda b: (b[0], -b[1])))
            b = (size, t, made)
            made += 1
        out.append((b[2], size - b[0]))
        if b[0] > n:
            bins.append((b[0] - n, t, b[2]))
    return out


@pytest.mark.parametrize("most", [1, 3, 50])
def test_bins_follow_the_rule(most):
    rng = random.Random(most)
    lengths = [rng.choice([1, 2, 5, 9, 20, 31, 32]) for _ in range(3000)]
    bins = packing.Bins(32, most)
    assert [bins.place(n) for n in lengths] == plain_best_fit(lengths, 32, most)
    assert bins.open <= most


def test_packing_in_rounds_loses_no_piece_and_little_space(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, 0, min(64, 1 + int(rng.expovariate(1 / 12)))) for i in range(6000)] + [(9999, k, 64) for k in range(5)]
    path = str(tmp_path / "parts")
    spark.createDataFrame(rows, "row long, piece int, length long").write.parquet(path)
    parts = spark.read.parquet(path)
    got = packing.packed(parts, size=64, most=8, share=2).collect()  # several rounds, many packers
    assert sorted((r.row, r.piece, r.length) for r in got) == sorted(rows)
    assert laid(got, 64) <= 1.02 * math.ceil(sum(r[2] for r in rows) / 64)
    assert packing.packed(parts.limit(0)).count() == 0


def test_sequences_hold_the_ids_end_to_end(spark, tmp_path):
    df, rows = packing_docs(spark)
    packing.pieces(df, FILE).write.parquet(str(tmp_path / "p"))
    parts = spark.read.parquet(str(tmp_path / "p"))
    by_piece = {(r.doc_id, r.piece, r.start, r.length, tuple(r.ids)) for r in parts.collect()}
    made = packing.sequences(parts).collect()
    seen = 0
    for r in made:
        at = 0
        for d in r.documents:
            assert d.offset == at and (d.doc_id, d.piece, d.start, d.length, tuple(r.ids[at : at + d.length])) in by_piece
            at += d.length
            seen += 1
        assert at == len(r.ids) <= 2048
    assert seen == parts.count()


def test_query_packs_well(spark):
    got = queries.op13_pack(spark, SF).collect()
    assert laid(got, 2048) <= math.ceil(sum(r.length for r in got) / 2048) + 1
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert {r.doc_id for r in got} == {r.doc_id for r in docs.select("doc_id").collect()}
