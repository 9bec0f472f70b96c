"""Classification of sequences against a reference ref(ref, ranks, seq)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scratch import materialise
from . import simjoin, taxonomy

ITERATIONS, PICKS = 100, 32


#: Queries and references of a block; a task holds a block of each.
QUERIES, REFERENCES = 2048, 4096
VOTES = "otu string, it int, c int, ref string"


def codes(text: str, k: int) -> np.ndarray:
    """The k-mers of a text as integers, k <= 8, in order."""
    b = np.frombuffer(text.encode("latin-1", "replace"), np.uint8)
    out = np.zeros(len(b) - k + 1, np.uint64)
    for i in range(k):
        out = (out << np.uint64(8)) | b[i : len(b) - k + 1 + i]
    return out


def block_votes(k: int, iterations: int):
    """The best reference of a block for each iteration of each query, by products of draws and k-mers."""

    def run(queries: pa.Table, refs: pa.Table) -> pa.Table:
        refs = sorted(zip(refs["ref"].to_pylist(), refs["seq"].to_pylist()))  # the first of the best is the smallest
        names, sets = [ref for ref, _ in refs], [np.unique(codes(x, k)) for _, x in refs]
        kmer, owner = np.concatenate([*sets, np.zeros(0, np.uint64)]), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        order = np.argsort(kmer, kind="stable")
        known, first = np.unique(kmer[order], return_index=True)
        owner, first = owner[order], np.append(first, len(kmer))
        schema = pa.schema([("otu", pa.string()), ("it", pa.int32()), ("c", pa.int32()), ("ref", pa.string())])
        out = [schema.empty_table()]
        for i in range(queries.num_rows if len(known) else 0):
            otu, text = queries["otu"][i].as_py(), queries["seq"][i].as_py()
            drawn = queries["draws"][i].values.to_numpy()
            every = codes(text, k)
            _, at = np.unique(every, return_index=True)
            mine = every[np.sort(at)]  # distinct, in the order of the text, as the draws count them
            place = np.minimum(np.searchsorted(known, mine), len(known) - 1)
            hit = np.flatnonzero(known[place] == mine)
            if not len(hit):
                continue
            draws = np.bincount(np.repeat(np.arange(iterations), len(drawn) // iterations) * len(mine) + drawn, minlength=iterations * len(mine))
            has = np.zeros((len(hit), len(names)), np.float32)
            for row, p in enumerate(place[hit]):
                has[row, owner[first[p] : first[p + 1]]] = 1
            votes = draws.reshape(iterations, len(mine))[:, hit].astype(np.float32) @ has
            best = votes.argmax(1)
            c = votes[np.arange(iterations), best].astype(np.int32)
            it = np.flatnonzero(c)
            out.append(pa.table([pa.array([otu] * len(it), pa.string()), it.astype(np.int32), c[it], pa.array([names[b] for b in best[it]], pa.string())], schema))
        return pa.concat_tables(out)

    return run


def bootstrap(queries: DataFrame, ref: DataFrame, k: int = 8, iterations: int = ITERATIONS, picks: int = PICKS, query_block: int = QUERIES, ref_block: int = REFERENCES) -> DataFrame:
    """(otu, rank, name, support) for queries(otu, seq): how many of the iterations vote for each name, as a share.

    An iteration draws ``picks`` of the query's k-mers (k <= 8) by a hash, and the reference with most of them gives its
    ranks; ties go to the smallest ref. Draws that pick one k-mer twice count it twice. Queries are stated and meet all
    references in blocks, whatever k-mers they share: a pair of blocks gives at most one row for each query and iteration, and
    the best over blocks is a grouped minimum. A k-mer of all references costs a task what any other does. Of references with
    one sequence only the smallest can be the best, so blocks are made of distinct sequences.
    """
    if not 1 <= k <= 8:
        raise ValueError("k must be 1 to 8")
    q = queries.where(F.length("seq") >= k).select(F.col("otu").cast("string").alias("otu"), "seq")
    r = ref.where(F.length("seq") >= k).select(F.col("ref").cast("string").alias("ref"), "seq")
    r = materialise(r.groupBy("seq").agg(F.min("ref").alias("ref")).select("ref", "seq"), "references")
    n_q, n_r = (-(-df.count() // size) or 1 for df, size in ((q, query_block), (r, ref_block)))
    kmers = F.transform(F.sequence(F.lit(1), F.length("seq") - k + 1), lambda i: F.substring("seq", i, F.lit(k)))
    draw = F.transform(F.sequence(F.lit(0), F.lit(iterations * picks - 1)), lambda d: F.pmod(F.xxhash64("otu", d), F.col("n")).cast("int"))
    q = q.withColumn("n", F.size(F.array_distinct(kmers)).cast("long"))
    number = lambda column, n: F.pmod(F.xxhash64(column), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = q.withColumn("qb", number("otu", n_q)).withColumn("rb", every(n_r))
    r = r.withColumn("rb", number("ref", n_r)).withColumn("qb", every(n_q))
    # drawn behind the shuffle: the draws of a query are a hundred times its sequence
    q = q.repartition("qb", "rb").select("otu", "seq", "qb", "rb", draw.alias("draws"))
    votes = q.groupBy("qb", "rb").cogroup(r.groupBy("qb", "rb")).applyInArrow(block_votes(k, iterations), VOTES)
    best = votes.groupBy("otu", "it").agg(F.min(F.struct((-F.col("c")).alias("c"), "ref")).alias("b")).select("otu", F.col("b.ref").alias("ref"))
    won = best.groupBy("otu", "ref").agg(F.count("*").alias("times"))
    ranked = ref.select(F.col("ref").cast("string").alias("ref"), "ranks").join(r.select("ref"), "ref", "left_semi")
    named = won.join(ranked, "ref").select("otu", "times", F.posexplode("ranks").alias("rank", "name"))
    return named.groupBy("otu", "rank", "name").agg((F.sum("times") / F.lit(float(iterations))).alias("support"))


def sintax(queries: DataFrame, ref: DataFrame, cutoff: float = 0.8, k: int = 8, **options) -> DataFrame:
    """(otu, score, ranks): at each rank the name with most support, down to the last rank that reaches the cutoff; the
    score is that rank's support. Queries that keep no rank have an empty list and score 0."""
    s = bootstrap(queries, ref, k, **options)
    top = s.groupBy("otu", "rank").agg(F.min(F.struct((-F.col("support")).alias("s"), "name")).alias("b")).select("otu", "rank", (-F.col("b.s")).alias("support"), "b.name")
    low = F.max((F.col("support") < cutoff).cast("int")).over(Window.partitionBy("otu").orderBy("rank"))
    kept = top.withColumn("_low", low).where("_low = 0").groupBy("otu").agg(F.array_sort(F.collect_list(F.struct("rank", "name"))).alias("l"), F.max_by("support", "rank").alias("score"))
    out = queries.select("otu").join(kept, "otu", "left")
    return out.select("otu", F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce(F.transform("l", lambda x: x["name"]), F.array().cast("array<string>")).alias("ranks"))


def aligned(queries: DataFrame, ref: DataFrame, identity: float = 0.7, k: int | None = None) -> DataFrame:
    """(otu, pident, ref, lca, ranks) from all reference hits tied at the best identity, either strand, by their LCA."""
    hits = simjoin.top_hits(queries.select(F.col("otu").alias("id"), "seq"), ref.select(F.col("ref").alias("id"), "seq"), identity, k).where("target is not null")
    full = hits.join(ref.select(F.col("ref").alias("target"), "ranks"), "target")
    return taxonomy.top_hits_lca(full.select(F.col("query").alias("otu"), F.col("target").alias("pos"), (F.col("pident") / 100).alias("pident"), F.col("target").alias("ref"), "ranks"))


def hybrid(queries: DataFrame, ref: DataFrame, cutoff: float = 0.8, identity: float = 0.7) -> DataFrame:
    """(otu, taxonomy): alignment and classifier results joined to a consensus; "No hit" where neither says anything."""
    a = aligned(queries, ref, identity)
    c = sintax(queries, ref, cutoff).where(F.size("ranks") > 0).withColumn("method", F.lit("S"))
    both = taxonomy.consensus(a, c)
    alone = c.join(a, "otu", "left_anti").select("otu", F.concat(F.lit("SS|"), F.format_string("%.4f", F.col("score")), F.lit("|None;"), F.array_join("ranks", ",")).alias("taxonomy"))
    found = both.unionByName(alone)
    return queries.select("otu").join(found, "otu", "left").withColumn("taxonomy", F.coalesce("taxonomy", F.lit("No hit")))
