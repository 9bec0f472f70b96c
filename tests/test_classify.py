import collections
import random

from pyspark.sql import functions as F

from sporemill.operators import classify


def brute(spark, queries, refs, iterations, picks, k=8):
    """{(otu, rank, name): support} by plain counting; only the draws are Spark's."""
    drawn = queries.select("otu", F.transform(F.sequence(F.lit(0), F.lit(iterations * picks - 1)), lambda d: F.xxhash64("otu", d)).alias("d"))
    drawn = {r.otu: r.d for r in drawn.collect()}
    kmers = lambda s: list(dict.fromkeys(s[i : i + k] for i in range(len(s) - k + 1)))
    known = [(r.ref, r.ranks, set(kmers(r.seq))) for r in refs.collect() if r.seq and len(r.seq) >= k]
    out = collections.Counter()
    for q in queries.collect():
        grams = kmers(q.seq or "")
        for it in range(iterations) if grams else ():
            c = collections.Counter(grams[h % len(grams)] for h in drawn[q.otu][it * picks : (it + 1) * picks])
            votes = [(-sum(n for g, n in c.items() if g in have), ref, ranks) for ref, ranks, have in known]
            n, _, ranks = min(votes, default=(0, "", []))
            for rank, name in enumerate(ranks if n else ()):
                out[q.otu, rank, name] += 1
    return {key: n / iterations for key, n in out.items()}


def test_bootstrap_equals_counting(spark):
    rng = random.Random(3)
    conserved = "".join(rng.choices("ACGT", k=60))  # all references share it
    base = ["".join(rng.choices("ACGT", k=90)) for _ in range(6)]
    change = lambda s, n: "".join(rng.choice("ACGT") if rng.random() < n else c for c in s)
    refs = [(f"r{i:02d}", [f"k:{i % 2}", f"g:{i % 6}", f"s:{i}"], conserved + change(base[i % 6], 0.04)) for i in range(40)]
    refs += [("same", ["k:same"], refs[0][2]), ("short", ["k:x"], "ACGT"), ("none", ["k:x"], None), ("bare", [], refs[1][2])]
    queries = [(f"q{i}", change(conserved, 0.02) + change(base[i % 6], 0.05)) for i in range(17)]
    queries += [("short", "ACG"), ("none", None), ("far", "".join(rng.choices("ACGT", k=100))), ("eight", conserved[:8]), ("poly", "A" * 50)]
    q = spark.createDataFrame(queries, "otu string, seq string")
    r = spark.createDataFrame(refs, "ref string, ranks array<string>, seq string")
    want = brute(spark, q, r, 20, 16)
    for blocks in ({}, {"query_block": 5, "ref_block": 7}):
        got = classify.bootstrap(q, r, iterations=20, picks=16, **blocks)
        assert {(x.otu, x["rank"], x.name): x.support for x in got.collect()} == want
    assert len({o for o, _, _ in want}) >= 17
    assert classify.bootstrap(q, r.where("false")).count() == 0 == classify.bootstrap(q.where("false"), r).count()


def test_query_against_counting(spark):
    from sporemill.plans import queries as q
    from sporemill.plans import classify_queries as c

    sf = "/root/testdata/sf0.001"
    otus, refs = c.sequences(spark, sf)
    some = otus.where("hash(otu) % 5 = 0")
    want = brute(spark, some, refs, c.ITERATIONS, classify.PICKS)
    got = collections.defaultdict(list)
    for r in q.QUERIES["classified_customers"](spark, sf).collect():
        got[r.otu].append((r["rank"], r.name, r.support))
    assert len(got) == otus.count()
    for o in [r.otu for r in some.collect()]:
        for rank, name, support in got[o]:
            if name is not None:
                best = min((-n, x) for (otu, k, x), n in want.items() if otu == o and k == rank)
                assert (name, support) == (best[1], -best[0])


def test_copies_of_references_meet_no_query(spark, monkeypatch):
    plain = classify.block_votes

    def checked(k, iterations):
        run = plain(k, iterations)

        def only_distinct(queries, refs):
            texts = refs["seq"].to_pylist()
            assert len(set(texts)) == len(texts)
            return run(queries, refs)

        return only_distinct

    monkeypatch.setattr(classify, "block_votes", checked)
    rng = random.Random(8)
    texts = ["".join(rng.choices("ACGT", k=60)) for _ in range(3)]
    r = spark.createDataFrame([(f"r{i:03d}", [f"s:{i}"], texts[i % 3]) for i in range(60)], "ref string, ranks array<string>, seq string")
    q = spark.createDataFrame([(f"q{i}", t) for i, t in enumerate(texts)], "otu string, seq string")
    got = {(x.otu, x.name): x.support for x in classify.bootstrap(q, r, iterations=10).collect()}
    assert got == {(f"q{i}", f"s:{i}"): 1.0 for i in range(3)}
