"""Classification against references: customers' sequences by those of parts, of which they are changed copies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import classify
from . import views as v
from .queries import QUERIES
from .variant_queries import spelt

ITERATIONS = 100


def sequences(spark, sf_dir):
    """otus(otu, seq) and refs(ref, ranks, seq). A part is a reference: 32 bases that all have, and 96 that its number modulo
    50 gives, so that parts of one species are alike. A customer is an OTU: a species with 8 bases of its own in the middle."""
    text = lambda c, middle: F.concat(spelt(F.lit("conserved")), spelt(F.concat(F.lit("x"), c)), middle, spelt(F.concat(F.lit("z"), c)))
    c, p = F.col("c_custkey") % 60, F.col("p_partkey") % 50
    own = F.concat(F.left(spelt(F.concat(F.lit("y"), c)), F.lit(12)), F.left(spelt(F.concat(F.lit("own"), "c_custkey")), F.lit(8)), F.substring(spelt(F.concat(F.lit("y"), c)), 21, 12))
    otus = v.table(spark, sf_dir, "customer").select(F.concat(F.lit("C"), "c_custkey").alias("otu"), text(c, own).alias("seq"))
    ranks = F.array(*[F.concat(F.lit(f"{r}:"), x.cast("string")) for r, x in (("k", p % 2), ("g", p % 10), ("s", p))])
    refs = v.table(spark, sf_dir, "part").select(F.concat(F.lit("P"), "p_partkey").alias("ref"), ranks.alias("ranks"), text(p, spelt(F.concat(F.lit("y"), p))).alias("seq"))
    return otus, refs


def classified_customers(spark, sf_dir):
    """At each rank the name with most support of a hundred draws; no SQL has the hash that draws, so a test counts."""
    otus, refs = sequences(spark, sf_dir)
    support = classify.bootstrap(otus, refs, iterations=ITERATIONS)
    top = support.groupBy("otu", "rank").agg(F.min(F.struct((-F.col("support")).alias("s"), "name")).alias("b"))
    top = top.select("otu", "rank", "b.name", (-F.col("b.s")).alias("support"))
    return otus.select("otu").join(top, "otu", "left")


QUERIES["classified_customers"] = classified_customers
