"""Taxonomy: rank lists (array<string> of "k:Fungi", "p:..."), consensus, summaries, exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rank letters in order.
RANKS = ("k", "p", "c", "o", "f", "g", "s")
RANK_NAMES = {"k": "kingdom", "p": "phylum", "c": "class", "o": "order", "f": "family", "g": "genus", "s": "species"}
UNCLASSIFIED = "Unclassified"


def parse_ranks(tax: Column) -> Column:
    """"Method|Score|Ref;k:..,p:.." or "k:..,p:.." to the rank list."""
    return F.split(F.element_at(F.split(tax, ";"), -1), ",")


def rank_value(ranks: Column, rank: str) -> Column:
    """The name at a rank, or null."""
    found = F.filter(ranks, lambda x: F.startswith(x, F.lit(rank + ":")))
    return F.nullif(F.substring(F.get(found, F.lit(0)), 3, 10_000), F.lit(""))


def truncate(ranks: Column, levels: int) -> Column:
    return F.slice(ranks, 1, levels)


def qiime(ranks: Column) -> Column:
    """k:.. to k__..; ranks missing between present ones come empty, trailing ones not at all. "d:" may stand for "k:".

    A list of one level or without taxonomy gives the seven empty ranks below what it has.
    """
    names = F.map_from_entries(
        F.array_distinct(F.transform(F.filter(ranks, lambda x: x.rlike("^[dkpcofgs]:")), lambda x: F.struct(F.translate(F.left(x, F.lit(1)), "d", "k").alias("k"), F.substring(x, 3, 10_000).alias("v"))))
    )
    domain = F.exists(ranks, lambda x: F.startswith(x, F.lit("d:")))
    order = F.array(*map(F.lit, RANKS))
    has = F.filter(F.sequence(F.lit(1), F.lit(len(RANKS))), lambda i: F.map_contains_key(names, F.element_at(order, i)))
    deepest = F.coalesce(F.array_max(has), F.lit(0))
    depth = F.when(deepest <= 1, len(RANKS)).otherwise(deepest)
    text = F.array_join(F.transform(F.slice(order, F.lit(1), depth), lambda r: F.concat(r, F.lit("__"), F.coalesce(names[r], F.lit("")))), "; ")
    return F.when(domain, F.regexp_replace(text, "^k__", "d__")).otherwise(text)


def longest(hits: DataFrame, key: str) -> DataFrame:
    """Of each key's hits those with the most ranks."""
    most = F.max(F.size("ranks")).over(Window.partitionBy(key))
    return hits.withColumn("_m", most).where(F.size("ranks") == F.col("_m")).drop("_m")


def top_hits_lca(hits: DataFrame) -> DataFrame:
    """Hits (otu, pos, pident, ref, ranks), all tied at the best identity, to one row an OTU: (otu, pident, ref, lca, ranks).

    Of the hits with the most ranks the first (least ``pos``) names reference and identity; if there are several, the
    ranks are those that all of them have, in the first one's order, and ``lca`` tells whether that shortened the list.
    A rank that all have is one that is counted as often as there are hits, so no list of hits is gathered.
    """
    h = longest(hits, "otu")
    first = h.groupBy("otu").agg(F.min_by(F.struct("pident", "ref", "ranks"), "pos").alias("f"), F.count("*").alias("k"))
    shared = h.select("otu", F.explode(F.array_distinct("ranks")).alias("r")).groupBy("otu", "r").agg(F.count("*").alias("c"))
    listed = first.select("otu", "k", "f", F.posexplode("f.ranks").alias("i", "r")).join(shared, ["otu", "r"]).where("c = k")
    kept = listed.groupBy("otu").agg(F.array_sort(F.collect_list(F.struct("i", "r"))).alias("l"))
    out = first.join(kept, "otu", "left").select("otu", "f", F.coalesce(F.transform("l", lambda x: x["r"]), F.array().cast("array<string>")).alias("ranks"))
    return out.select("otu", "f.pident", "f.ref", (F.size("ranks") < F.size("f.ranks")).alias("lca"), "ranks")


def best_classifier(utax: DataFrame, sintax: DataFrame) -> DataFrame:
    """Two classifiers' results (otu, score, ranks) to one (otu, score, method, ranks): more ranks win, then the higher
    score; U wins ties."""
    u = utax.select("otu", F.struct("score", F.lit("U").alias("method"), "ranks").alias("u"))
    s = sintax.select("otu", F.struct("score", F.lit("S").alias("method"), "ranks").alias("s"))
    nu, ns = F.size("u.ranks"), F.size("s.ranks")
    take_u = F.col("s").isNull() | (nu > ns) | ((nu == ns) & (F.col("u.score") >= F.col("s.score")))
    best = F.when(F.col("u").isNotNull() & take_u, F.col("u")).otherwise(F.col("s"))
    return u.join(s, "otu", "full_outer").select("otu", best.alias("b")).select("otu", "b.*")


def consensus(aligned: DataFrame, classified: DataFrame, cutoff: float = 0.97) -> DataFrame:
    """Alignment (otu, pident as a share, ref, lca, ranks) and classifier (otu, score, method, ranks) to (otu, taxonomy).

    Below ``cutoff`` a classifier result is taken. Otherwise the alignment's ranks stand, extended by the classifier's
    if those are more; the first rank that the classifier lacks cuts the list there (flag D). LCA and D add an L.
    """
    c = classified.select("otu", F.col("score").alias("c_score"), F.col("method").alias("c_method"), F.col("ranks").alias("c_ranks"))
    j = aligned.join(c, "otu", "left")
    g, k = F.col("ranks"), F.col("c_ranks")
    has = F.coalesce(F.size(k) > 0, F.lit(False)) & k.isNotNull()
    lower = has & (F.col("pident") < cutoff)
    longer = has & (F.size(g) < F.size(k))
    lacking = F.filter(F.sequence(F.lit(1), F.size(g)), lambda i: ~F.array_contains(k, F.element_at(g, i)))
    broken = longer & (F.size(g) > 0) & (F.size(lacking) > 0)
    tax = F.when(broken, F.slice(g, F.lit(1), F.get(lacking, F.lit(0)) - 1)).when(longer, k).otherwise(g)
    flag = F.when(broken, "D").otherwise("S")
    more = F.when(broken | F.col("lca"), "L").otherwise("")
    by_classifier = F.concat("c_method", F.lit("S|"), F.format_string("%.4f", F.col("c_score").cast("double")), F.lit("|"), "ref", F.lit(";"), F.array_join(k, ","))
    by_alignment = F.concat(F.lit("G"), flag, more, F.lit("|"), F.format_string("%.1f", F.col("pident").cast("double") * 100), F.lit("|"), "ref", F.lit(";"), F.array_join(tax, ","))
    return j.select("otu", F.when(lower, by_classifier).otherwise(by_alignment).alias("taxonomy"))


def attach(counts: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """(otu, sample, n, taxonomy), "No hit" where there is none."""
    return counts.join(taxonomy.select("otu", "taxonomy"), "otu", "left").withColumn("taxonomy", F.coalesce("taxonomy", F.lit("No hit")))


def with_text(taxonomy: DataFrame, text: str) -> DataFrame:
    """OTUs whose taxonomy contains a text."""
    return taxonomy.where(F.col("taxonomy").contains(text))


def summarise(counts: DataFrame, ranks: DataFrame, levels: tuple[str, ...] = RANKS, presence: bool = False) -> DataFrame:
    """(rank, taxon, sample, n, percent): reads, or OTUs present, per rank and taxon; percent of the sample's sum.

    OTUs without the rank, or without taxonomy, are Unclassified. A rank in which nothing is classified is left out.
    """
    value = F.lit(1).cast("long") if presence else F.col("n")
    named = ranks.select("otu", F.array(*[F.struct(F.lit(r).alias("rank"), F.coalesce(rank_value(F.col("ranks"), r), F.lit(UNCLASSIFIED)).alias("taxon")) for r in levels]).alias("t"))
    none = F.array(*[F.struct(F.lit(r).alias("rank"), F.lit(UNCLASSIFIED).alias("taxon")) for r in levels])
    each = counts.withColumn("v", value).join(named, "otu", "left").select("sample", "v", F.explode(F.coalesce("t", none)).alias("t"))
    s = each.groupBy("t.rank", "t.taxon", "sample").agg(F.sum("v").alias("n"))
    s = s.withColumn("_c", F.max(F.col("taxon") != UNCLASSIFIED).over(Window.partitionBy("rank"))).where("_c")
    return s.select("rank", "taxon", "sample", "n", (F.col("n") / F.sum("n").over(Window.partitionBy("rank", "sample")) * 100).alias("percent"))


def collapse(counts: DataFrame, ranks: DataFrame, depth: int, compat: bool = False) -> DataFrame:
    """Sums OTUs that have the same taxonomy of at least ``depth`` ranks: (otu, sample, n), named cOTUs_<a>_<b>..

    OTUs of less depth, and those alone with their taxonomy, pass as they are. ``compat`` keeps of the OTUs of less depth
    only the first of each taxonomy.
    """
    if compat:
        shallow = ranks.where(F.size("ranks") < depth).groupBy(F.array_join("ranks", ",").alias("tax")).agg(F.min("otu").alias("first"))
        later = ranks.where(F.size("ranks") < depth).join(shallow, F.array_join("ranks", ",") == F.col("tax")).where("otu <> first")
        counts = counts.join(later.select("otu"), "otu", "left_anti")
    deep = ranks.where(F.size("ranks") >= depth).select("otu", F.array_join("ranks", ",").alias("tax"))
    names = deep.groupBy("tax").agg(F.count("*").alias("k"), F.array_join(F.array_sort(F.collect_list("otu")), "_").alias("all")).where("k > 1")
    names = deep.join(names, "tax").select("otu", F.concat(F.lit("cOTUs_"), "all").alias("name"))
    return counts.join(names, "otu", "left").groupBy(F.coalesce("name", "otu").alias("otu"), "sample").agg(F.sum("n").alias("n"))


def members(ranks: DataFrame) -> DataFrame:
    """(taxonomy, otus): the OTUs of each full taxonomy, comma-joined."""
    return ranks.groupBy(F.array_join("ranks", ",").alias("taxonomy")).agg(F.array_join(F.array_sort(F.collect_list("otu")), ",").alias("otus"))


def guilds(ranks: DataFrame, traits: DataFrame) -> DataFrame:
    """(otu, taxon, <trait columns>): the trait row of the deepest rank that the trait table knows; null where none."""
    columns = [c for c in traits.columns if c != "taxon"]
    each = ranks.select("otu", F.posexplode("ranks").alias("pos", "r")).select("otu", "pos", F.replace(F.regexp_replace("r", "^[a-z]:", ""), F.lit("_"), F.lit(" ")).alias("taxon"))
    hit = each.join(traits, "taxon").groupBy("otu").agg(F.max_by(F.struct("taxon", *columns), "pos").alias("t"))
    return ranks.select("otu").join(hit, "otu", "left").select("otu", "t.*")


def guild_stats(found: DataFrame, column: str) -> DataFrame:
    return found.groupBy(F.coalesce(F.col(column), F.lit(UNCLASSIFIED)).alias(column)).agg(F.count("*").alias("otus"))


def guild_summary(found: DataFrame, *columns: str) -> DataFrame:
    """(what, value, otus): how many OTUs have each value of the trait columns, Unclassified where a column is null, and
    the distinct values of each column as what = "distinct <column>"."""
    each = found.select("otu", F.explode(F.array(*[F.struct(F.lit(c).alias("what"), F.coalesce(F.col(c), F.lit(UNCLASSIFIED)).alias("value")) for c in columns])).alias("e"))
    n = each.groupBy("e.what", "e.value").agg(F.count("*").alias("otus"))
    distinct = n.where(F.col("value") != UNCLASSIFIED).groupBy(F.concat(F.lit("distinct "), "what").alias("what")).agg(F.lit("").alias("value"), F.count("*").alias("otus"))
    return n.unionByName(distinct.select("what", "value", "otus"))


def at_rank(ranks: DataFrame, rank: str) -> DataFrame:
    """(otu, taxon) at a rank, the name cut at its first comma and blank; Unclassified where there is none."""
    name = F.substring_index(F.substring_index(F.coalesce(rank_value(F.col("ranks"), rank), F.lit(UNCLASSIFIED)), ",", 1), " ", 1)
    return ranks.select("otu", name.alias("taxon"))


def split_by_taxon(counts: DataFrame, ranks: DataFrame, rank: str) -> DataFrame:
    """(taxon, otu, sample, n): a count table for every taxon of a rank."""
    c = counts.join(at_rank(ranks, rank), "otu", "left")
    return c.select(F.coalesce("taxon", F.lit(UNCLASSIFIED)).alias("taxon"), "otu", "sample", "n")


def scored_ranks(text: Column, cutoff: float = 0.8) -> Column:
    """"k:Fungi(1.0),p:..(0.93)" to the leading ranks whose scores reach the cutoff."""
    each = F.split(text, ",")
    score = lambda x: F.regexp_extract(x, r"\(([0-9.]+)\)$", 1).cast("double")
    low = F.filter(F.sequence(F.lit(1), F.size(each)), lambda i: F.coalesce(score(F.element_at(each, i)) < cutoff, F.lit(True)))
    keep = F.coalesce(F.get(low, F.lit(0)) - 1, F.size(each))
    return F.transform(F.slice(each, F.lit(1), keep), lambda x: F.regexp_replace(x, r"\([0-9.]+\)$", ""))
