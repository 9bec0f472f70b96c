"""More registered queries of the marker-gene operators: count tables, taxonomy, statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scratch import materialise
from ..operators import ecology, ordination, reads, refdb, table, taxonomy
from ..sources import scans, sinks
from . import pipelines
from . import views as v
from .queries import NORM, filtered, groups, query, rounded
from .read_queries import SUPPLIERS, suppliers

# ---- count tables ----------------------------------------------------------------------------------------------------


@query("SELECT 'otu' AS what, otu AS name, CAST(sum(n) AS BIGINT) AS total FROM counts GROUP BY ALL UNION ALL SELECT 'sample', sample, CAST(sum(n) AS BIGINT) FROM counts GROUP BY ALL", v.COUNTS)
def totals(spark, sf_dir):
    c = materialise(v.counts(spark, sf_dir), "counts")
    return reads.union_of(*[table.totals(c, by).select(F.lit(by).alias("what"), F.col(by).alias("name"), "total") for by in ("otu", "sample")])


@query("SELECT otu, sample, CAST(round_even(n / (100 + length(sample)) * 1000, 0) AS BIGINT) AS n FROM counts", v.COUNTS)
def rate_normalise(spark, sf_dir):
    """Counts over totals that are given from outside."""
    c = v.counts(spark, sf_dir)
    return table.rate_normalise(c, c.select("sample", (F.length("sample") + 100).alias("total")).distinct(), 1000)


@query("SELECT otu, count(*) AS samples FROM counts GROUP BY 1", v.COUNTS)
def presence(spark, sf_dir):
    return table.presence(v.counts(spark, sf_dir)).groupBy("otu").agg(F.sum("n").alias("samples"))


@query(
    "SELECT otu, sample, round(CASE WHEN hi > lo THEN (n - lo) / (hi - lo) ELSE 0 END, 6) AS value FROM (SELECT otu, sample, CAST(n AS DOUBLE) AS n, CASE WHEN count(*) OVER w < (SELECT count(DISTINCT sample) FROM counts) THEN 0 ELSE min(n) OVER w END AS lo, max(n) OVER w AS hi FROM counts WINDOW w AS (PARTITION BY otu))",
    v.COUNTS,
)
def standard_rows(spark, sf_dir):
    c = v.counts(spark, sf_dir)
    return rounded(table.scale_rows(c, c, "standard"), "value")


@query(
    "SELECT otu, sample, n FROM rich WHERE otu IN (SELECT otu FROM rich GROUP BY otu HAVING sum(n) > 1)",
    v.COUNTS, "rich AS (SELECT * FROM counts WHERE n > 2 AND sample IN (SELECT sample FROM counts WHERE n > 2 GROUP BY sample HAVING count(DISTINCT otu) >= 10))",
)
def keep_rich_samples(spark, sf_dir):
    return table.keep_rich_samples(v.counts(spark, sf_dir).where("n > 2"), 10)


@query("SELECT otu, sample, n FROM counts WHERE sample NOT LIKE '%2'", v.COUNTS)
def drop_table_samples(spark, sf_dir):
    c = v.counts(spark, sf_dir)
    return table.drop_samples(c, c.select("sample").where("sample like '%2'").distinct())


@query(
    f"SELECT round(sum(coalesce(d, coalesce(l, 1)) * n) / sum(coalesce(l, 1) * n) * 100, 6) AS error_percent FROM counts LEFT JOIN (SELECT otu, 100 + k % 50 AS l, k % 4 AS d FROM sup WHERE k % 5 > 0) USING (otu) WHERE sample = '{v.MOCK_SAMPLE}'",
    v.COUNTS, SUPPLIERS,
)
def mock_error(spark, sf_dir):
    hits = suppliers(spark, sf_dir).where("k % 5 > 0").select("otu", (F.col("k") % 50 + 100).alias("length"), (F.col("k") % 4).alias("diffs"))
    return rounded(table.mock_error(v.counts(spark, sf_dir), hits, v.MOCK_SAMPLE), "error_percent")


MOCK_HITS = "hit AS (SELECT otu, 'm' || (k % 6) AS mock, 93 + k % 7 AS pident, 100 + k % 13 AS length, t FROM sup JOIN (SELECT otu, sum(n) AS t FROM counts GROUP BY 1) USING (otu) WHERE k % 6 < 4)"
MOCK_BEST = "best AS (SELECT *, CASE WHEN pident >= 97 THEN 'hit' WHEN pident >= 95 THEN 'variant' ELSE 'chimera' END AS class FROM (SELECT *, row_number() OVER (PARTITION BY mock ORDER BY t * pident * length DESC, otu) AS b FROM (SELECT *, row_number() OVER (PARTITION BY mock ORDER BY t DESC, pident DESC, otu) AS a FROM hit) WHERE a <= 3) WHERE b = 1)"


def mock_classes_of(spark, sf_dir):
    k = F.col("k")
    hits = suppliers(spark, sf_dir).where("k % 6 < 4").select("otu", F.concat(F.lit("m"), k % 6).alias("mock"), (k % 7 + 93).alias("pident"), (k % 13 + 100).alias("length"))
    return table.classify_mock_hits(hits, table.totals(v.counts(spark, sf_dir), "otu"))


@query(
    "SELECT mock, otu, pident, class FROM best UNION ALL SELECT DISTINCT 'm' || (k % 6), NULL, NULL, 'missing' FROM sup WHERE k % 6 >= 4",
    v.COUNTS, SUPPLIERS, MOCK_HITS, MOCK_BEST,
)
def mock_classes(spark, sf_dir):
    """The best OTU of each mock member and what it is, and the members that no OTU hits."""
    best = materialise(mock_classes_of(spark, sf_dir), "mock")
    mock = suppliers(spark, sf_dir).select(F.concat(F.lit("m"), F.col("k") % 6).alias("mock"))
    return reads.union_of(best, table.missing_mocks(mock, best).withColumn("class", F.lit("missing")))


@query(
    "SELECT coalesce(mock || '_pident=' || printf('%.1f', pident::DOUBLE) || '_' || otu || CASE class WHEN 'chimera' THEN '_suspect_mock_chimera' WHEN 'variant' THEN '_suspect_mock_variant' ELSE '' END, otu) AS otu, sample, n FROM counts LEFT JOIN best USING (otu)",
    v.COUNTS, SUPPLIERS, MOCK_HITS, MOCK_BEST,
)
def mock_names(spark, sf_dir):
    return table.rename_mocks(v.counts(spark, sf_dir), mock_classes_of(spark, sf_dir))


@query(
    "SELECT c.otu, c.sample, c.n FROM counts c JOIN (SELECT otu, sample FROM (SELECT *, max(n) OVER (PARTITION BY otu) AS b FROM kept2) WHERE n > 0 AND n >= b * (SELECT rate FROM cut)) USING (otu, sample)",
    v.COUNTS, v.MOCKS, NORM,
    "kept2 AS (SELECT * FROM norm WHERE otu IN (SELECT otu FROM counts GROUP BY otu HAVING sum(n) >= 2))",
    f"cut AS (SELECT ceil(greatest(sum(CASE WHEN m AND sample <> '{v.MOCK_SAMPLE}' THEN n ELSE 0 END) / sum(CASE WHEN m THEN n ELSE 0 END), sum(CASE WHEN NOT m AND sample = '{v.MOCK_SAMPLE}' AND e > 0 THEN n ELSE 0 END) / sum(CASE WHEN sample = '{v.MOCK_SAMPLE}' THEN n ELSE 0 END)) * 1000) / 1000 AS rate FROM (SELECT *, otu IN (SELECT otu FROM mocks) AS m, sum(CASE WHEN sample <> '{v.MOCK_SAMPLE}' THEN n ELSE 0 END) OVER (PARTITION BY otu) AS e FROM norm))",
)
def clean_table(spark, sf_dir):
    """The clean-up with the bleed rate measured on the mock sample."""
    return pipelines.clean_table(v.counts(spark, sf_dir), v.mock_otus(spark, sf_dir), v.MOCK_SAMPLE)


@query("SELECT sample, treatment, otu, n FROM counts JOIN metadata USING (sample)", v.COUNTS, v.METADATA)
def metadata_by_otu(spark, sf_dir):
    """Sample rows with a value for every OTU, turned back to cells."""
    wide, header = sinks.metadata_by_otu(v.metadata(spark, sf_dir), v.counts(spark, sf_dir))
    cells = wide.select("sample", "treatment", F.posexplode("values").alias("at", "n")).where("n > 0")
    return cells.join(header, F.col("at") + 1 == F.col("place")).select("sample", "treatment", "otu", "n")


@query("SELECT DISTINCT 'lacking' AS what, sample FROM counts WHERE sample NOT LIKE '%1' UNION ALL SELECT 'twice', sample FROM metadata WHERE sample LIKE '%3'", v.COUNTS, v.METADATA)
def metadata_faults(spark, sf_dir):
    """Samples without metadata, and samples that the metadata has twice."""
    m = v.metadata(spark, sf_dir)
    lacking = sinks.missing_metadata(v.counts(spark, sf_dir), m.where("sample like '%1'"))
    twice = scans.duplicates(m.unionByName(m.where("sample like '%3'")), "sample")
    return lacking.select(F.lit("lacking").alias("what"), "sample").unionByName(twice.select(F.lit("twice").alias("what"), "sample"))


# ---- taxonomy --------------------------------------------------------------------------------------------------------

VOTE = "SELECT otu, CASE WHEN u IS NOT NULL AND (s IS NULL OR len(u) > len(s) OR (len(u) = len(s) AND us >= ss)) THEN struct_pack(a := us, m := 'U', r := u) ELSE struct_pack(a := ss, m := 'S', r := s) END AS b FROM (SELECT otu, CASE WHEN k % 3 > 0 THEN ranks END AS u, CASE WHEN k % 3 > 0 THEN (k % 10) / 10.0 END AS us, CASE WHEN k % 4 > 0 THEN ranks[1 : 1 + k % 3] END AS s, CASE WHEN k % 4 > 0 THEN 0.45 END AS ss FROM ranks JOIN sup USING (otu)) WHERE u IS NOT NULL OR s IS NOT NULL"


@query(f"SELECT otu, CAST(b.a AS DOUBLE) AS score, b.m AS method, array_to_string(b.r, ',') AS ranks FROM ({VOTE})", v.RANKS, SUPPLIERS)
def classifier_vote(spark, sf_dir):
    """Two classifiers: more ranks win, then the higher score."""
    r = v.ranks(spark, sf_dir).join(suppliers(spark, sf_dir).select("otu", "k"), "otu")
    u = r.where("k % 3 > 0").select("otu", ((F.col("k") % 10) / 10.0).alias("score"), "ranks")
    s = r.where("k % 4 > 0").select("otu", F.lit(0.45).alias("score"), F.slice("ranks", F.lit(1), (F.col("k") % 3 + 1).cast("int")).alias("ranks"))
    return taxonomy.best_classifier(u, s).select("otu", "score", "method", F.array_join("ranks", ",").alias("ranks"))


CONSENSUS = """SELECT otu, CASE WHEN k IS NOT NULL AND pident < 0.97 THEN 'SS|0.9000|ref;' || array_to_string(k, ',')
  WHEN broken THEN 'GDL|' || printf('%.1f', pident * 100) || '|ref;' || array_to_string(g[1 : f - 1], ',')
  ELSE 'GS' || CASE WHEN lca THEN 'L' ELSE '' END || '|' || printf('%.1f', pident * 100) || '|ref;' || array_to_string(CASE WHEN k IS NOT NULL AND len(g) < len(k) THEN k ELSE g END, ',') END AS taxonomy
FROM (SELECT *, k IS NOT NULL AND len(g) < len(k) AND f IS NOT NULL AS broken FROM (SELECT *, list_min(list_filter(range(1, len(g) + 1), lambda i: NOT list_contains(k, g[i]))) AS f FROM (
  SELECT otu, n, ranks AS g, CASE WHEN n % 3 = 0 THEN 0.95::DOUBLE ELSE 0.99::DOUBLE END AS pident, n % 5 = 0 AS lca,
    CASE n % 4 WHEN 0 THEN NULL WHEN 1 THEN list_concat(ranks, ['o:X', 'f:Y']) WHEN 2 THEN list_concat([ranks[1], 'p:Other'], ['c:A', 'o:B']) ELSE [ranks[1]] END AS k
  FROM ranks JOIN (SELECT otu, k AS n FROM sup) USING (otu))))"""


@query(CONSENSUS, v.RANKS, SUPPLIERS)
def hybrid_consensus(spark, sf_dir):
    """Alignments and classifier results: extended, cut where they differ, or replaced below the cutoff."""
    r = v.ranks(spark, sf_dir).join(suppliers(spark, sf_dir).select("otu", "k"), "otu")
    n, first = F.col("k"), F.array(F.get("ranks", F.lit(0)))
    aligned = r.select("otu", F.when(n % 3 == 0, 0.95).otherwise(0.99).alias("pident"), F.lit("ref").alias("ref"), (n % 5 == 0).alias("lca"), "ranks")
    lists = F.when(n % 4 == 1, F.concat("ranks", F.array(F.lit("o:X"), F.lit("f:Y")))).when(n % 4 == 2, F.concat(first, F.array(*map(F.lit, ("p:Other", "c:A", "o:B"))))).otherwise(first)
    classified = r.where("k % 4 > 0").select("otu", F.lit(0.9).alias("score"), F.lit("S").alias("method"), lists.alias("ranks"))
    return taxonomy.consensus(aligned, classified)


@query(
    "SELECT what, value, otus FROM (SELECT 'guild' AS what, coalesce(guild, 'Unclassified') AS value, count(*) AS otus FROM g GROUP BY ALL UNION ALL SELECT 'mode', coalesce(mode, 'Unclassified'), count(*) FROM g GROUP BY ALL UNION ALL SELECT 'distinct guild', '', count(DISTINCT guild) FROM g UNION ALL SELECT 'distinct mode', '', count(DISTINCT mode) FROM g)",
    SUPPLIERS, "g AS (SELECT otu, CASE WHEN k % 4 > 0 THEN 'g' || (nk % 5) END AS guild, CASE WHEN k % 4 > 0 THEN r_name END AS mode FROM sup)",
)
def guild_summary(spark, sf_dir):
    s, known = suppliers(spark, sf_dir), F.col("k") % 4 > 0
    return taxonomy.guild_summary(s.select("otu", F.when(known, F.concat(F.lit("g"), F.col("nk") % 5)).alias("guild"), F.when(known, F.col("r_name")).alias("mode")), "guild", "mode")


@query(
    "SELECT otu, sample, CAST(sum(n) AS BIGINT) AS n FROM (SELECT coalesce(name, otu) AS otu, sample, n FROM counts LEFT JOIN (SELECT unnest(o) AS otu, 'cOTUs_' || array_to_string(o, '_') AS name FROM (SELECT list_sort(list(otu)) AS o FROM ranks WHERE len(ranks) >= 3 GROUP BY array_to_string(ranks, ',') HAVING count(*) > 1)) USING (otu) WHERE otu NOT IN (SELECT otu FROM ranks JOIN (SELECT array_to_string(ranks, ',') AS t, min(otu) AS f FROM ranks WHERE len(ranks) < 3 GROUP BY 1) ON t = array_to_string(ranks, ',') WHERE otu <> f)) GROUP BY 1, 2",
    v.COUNTS, v.RANKS,
)
def collapse_first_only(spark, sf_dir):
    """Collapsed as older tables were: of the OTUs of few ranks the first of each taxonomy alone stays."""
    return taxonomy.collapse(v.counts(spark, sf_dir), v.ranks(spark, sf_dir), 3, compat=True)


# ---- statistics ------------------------------------------------------------------------------------------------------


@query(
    "SELECT k, round(p, 9) AS p, round(least(1, min(p * (SELECT count(*) FROM t) / r) OVER (ORDER BY r DESC ROWS UNBOUNDED PRECEDING)), 9) AS fdr FROM (SELECT *, row_number() OVER (ORDER BY p, k) AS r FROM t)",
    "t AS (SELECT o_orderkey AS k, pow((o_orderkey * 7919 % 10007) / 10007.0, 3) AS p FROM orders)",
)
def adjusted_p(spark, sf_dir):
    t = v.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.pow((F.col("o_orderkey") * 7919 % 10007) / 10007.0, F.lit(3)).alias("p"))
    return rounded(ecology.benjamini_hochberg(t), "p", "fdr", digits=9)


GROUPS = "g AS (SELECT sample, treatment AS grp FROM metadata WHERE treatment <> 'no_data')"
BRAY = "t0 AS (SELECT sample, sum(n) AS t FROM counts GROUP BY 1), x0 AS (SELECT a.sample AS s1, b.sample AS s2, sum(least(a.n, b.n)) AS m FROM counts a JOIN counts b USING (otu) WHERE a.sample < b.sample GROUP BY 1, 2), dist AS (SELECT a.sample AS s1, b.sample AS s2, 1 - 2 * coalesce(m, 0) / (a.t + b.t) AS d FROM t0 a JOIN t0 b ON a.sample < b.sample LEFT JOIN x0 ON s1 = a.sample AND s2 = b.sample)"


def dealt_sql(permutations: int, source: str = "g", name: str = "dealt") -> str:
    """The permuted labels, dealt by the same hashes."""
    return (
        f"{name} AS (SELECT perm, sample, grp FROM (SELECT perm, sample, row_number() OVER (PARTITION BY perm ORDER BY md5(CAST(perm AS VARCHAR) || ':' || sample || 'perm'), sample) AS r FROM range(1, {permutations + 1}) AS q(perm), {source}) "
        f"JOIN (SELECT grp, row_number() OVER (ORDER BY grp, sample) AS r FROM {source}) USING (r) UNION ALL SELECT 0, sample, grp FROM {source})"
    )


PERMANOVA = """use AS (SELECT s1, s2, d * d AS d2 FROM dist WHERE s1 IN (SELECT sample FROM g) AND s2 IN (SELECT sample FROM g)),
size AS (SELECT perm, grp, count(*) AS m FROM dealt GROUP BY 1, 2),
w AS (SELECT perm, sum(ss / m) AS w FROM (SELECT a.perm, a.grp, sum(d2) AS ss FROM use JOIN dealt a ON a.sample = s1 JOIN dealt b ON b.sample = s2 AND b.perm = a.perm WHERE a.grp = b.grp GROUP BY 1, 2) JOIN size USING (perm, grp) GROUP BY 1),
f AS (SELECT perm, k - 1 AS df, (al - w) / (k - 1) / (w / (n - k)) AS f, (al - w) / al AS r2 FROM w, (SELECT count(*) AS n, count(DISTINCT grp) AS k FROM g), (SELECT sum(d2) / (SELECT count(*) FROM g) AS al FROM use))"""
WITH_P = "(SELECT (count_if(f >= (SELECT f FROM f WHERE perm = 0) - 1e-12) + 1) / (count(*) + 1) FROM f WHERE perm > 0)"


@query(f"SELECT df, round(f, 6) AS f, round(r2, 6) AS r2, round({WITH_P}, 6) AS p FROM f WHERE perm = 0", v.COUNTS, v.METADATA, GROUPS, BRAY, dealt_sql(9999), PERMANOVA)
def permanova(spark, sf_dir):
    return rounded(ecology.permanova(materialise(ecology.bray_curtis(v.counts(spark, sf_dir)), "distances"), groups(spark, sf_dir), 9999), "f", "r2", "p")


CENTRES = """ways AS (SELECT s1, s2, d FROM dist UNION ALL SELECT s2, s1, d FROM dist),
own AS (SELECT a.sample, a.grp, sum(d * d) AS s FROM ways JOIN g a ON a.sample = s1 JOIN g b ON b.sample = s2 WHERE a.grp = b.grp GROUP BY 1, 2),
m AS (SELECT grp, count(*) AS m FROM g GROUP BY 1),
half AS (SELECT grp, sum(s) / any_value(m) / any_value(m) / 2 AS h FROM own JOIN m USING (grp) GROUP BY 1),
z AS (SELECT sample, grp, sqrt(greatest(s / m - h, 0)) AS z FROM own JOIN m USING (grp) JOIN half USING (grp))"""
DISPERSION = """per AS (SELECT perm, dealt.grp, count(*) AS m, avg(z) AS a, sum(z * z) AS q FROM dealt JOIN z USING (sample) GROUP BY 1, 2),
f AS (SELECT perm, (b - n * mean * mean) / (k - 1) / ((q - b) / (n - k)) AS f FROM (SELECT perm, sum(m) AS n, count(*) AS k, sum(m * a) / sum(m) AS mean, sum(m * a * a) AS b, sum(q) AS q FROM per GROUP BY 1))"""


@query(f"SELECT round(f, 6) AS f, round({WITH_P}, 6) AS p FROM f WHERE perm = 0", v.COUNTS, v.METADATA, GROUPS, BRAY, CENTRES, dealt_sql(9999, "z"), DISPERSION)
def dispersion(spark, sf_dir):
    return rounded(ecology.dispersion(materialise(ecology.bray_curtis(v.counts(spark, sf_dir)), "distances"), groups(spark, sf_dir), 9999), "f", "p")


@query("SELECT sample, grp, round(z, 6) AS z FROM z", v.COUNTS, v.METADATA, GROUPS, BRAY, CENTRES)
def centroid_distances(spark, sf_dir):
    return rounded(ecology.centroid_distances(ecology.bray_curtis(v.counts(spark, sf_dir)), groups(spark, sf_dir)), "z")


PAIRWISE = """gp AS (SELECT a.grp AS g1, b.grp AS g2 FROM (SELECT DISTINCT grp FROM g) a JOIN (SELECT DISTINCT grp FROM g) b ON a.grp < b.grp),
mem AS (SELECT g1, g2, sample, grp FROM gp JOIN g ON grp = g1 OR grp = g2),
sz AS (SELECT g1, g2, grp, count(*) AS m FROM mem GROUP BY ALL),
al AS (SELECT a.g1, a.g2, sum(d * d) / any_value(n) AS al, any_value(n) AS n FROM dist JOIN mem a ON a.sample = s1 JOIN mem b ON b.sample = s2 AND a.g1 = b.g1 AND a.g2 = b.g2 JOIN (SELECT g1, g2, count(*) AS n FROM mem GROUP BY ALL) c ON c.g1 = a.g1 AND c.g2 = a.g2 GROUP BY 1, 2),
memr AS (SELECT g1, g2, grp, row_number() OVER (PARTITION BY g1, g2 ORDER BY grp, sample) AS r FROM mem),
slots AS (SELECT perm, g1, g2, sample, row_number() OVER (PARTITION BY perm, g1, g2 ORDER BY md5(CAST(perm AS VARCHAR) || ':' || sample || 'perm'), sample) AS r FROM range(1, 1000) AS q(perm), mem),
pdealt AS (SELECT perm, g1, g2, sample, grp FROM slots JOIN memr USING (g1, g2, r) UNION ALL SELECT 0, g1, g2, sample, grp FROM mem),
pw AS (SELECT perm, g1, g2, sum(ss / m) AS w FROM (SELECT a.perm, a.g1, a.g2, a.grp, sum(d * d) AS ss FROM dist JOIN pdealt a ON a.sample = s1 JOIN pdealt b ON b.sample = s2 AND a.perm = b.perm AND a.g1 = b.g1 AND a.g2 = b.g2 WHERE a.grp = b.grp GROUP BY ALL) JOIN sz USING (g1, g2, grp) GROUP BY ALL),
pf AS (SELECT perm, g1, g2, (al - w) / (w / (n - 2)) AS f, (al - w) / al AS r2 FROM al JOIN pw USING (g1, g2)),
pt AS (SELECT r.g1, r.g2, r.f, r.r2, (count_if(o.f >= r.f - 1e-12) + 1) / (count(*) + 1) AS p FROM pf r JOIN pf o USING (g1, g2) WHERE r.perm = 0 AND o.perm > 0 GROUP BY ALL),
pa AS (SELECT *, least(1, p * (SELECT count(*) FROM gp)) AS adjusted FROM pt)"""


@query(
    "SELECT g1, g2, CAST(1 AS BIGINT) AS df, round(f, 6) AS f, round(r2, 6) AS r2, round(p, 6) AS p, round(adjusted, 6) AS adjusted, CASE WHEN adjusted <= 1e-4 THEN '***' WHEN adjusted <= 0.001 THEN '**' WHEN adjusted <= 0.01 THEN '*' WHEN adjusted <= 0.05 THEN '.' ELSE '' END AS sig FROM pa",
    v.COUNTS, v.METADATA, GROUPS, BRAY, PAIRWISE,
)
def pairwise_permanova(spark, sf_dir):
    d = materialise(ecology.bray_curtis(v.counts(spark, sf_dir)), "distances")
    return rounded(ecology.pairwise_permanova(d, groups(spark, sf_dir), 999), "f", "r2", "p", "adjusted")


@query()
def raup_crick(spark, sf_dir):
    """Pairs of samples against null communities of the same richness."""
    return rounded(ecology.raup_crick(v.counts(spark, sf_dir)), "d")


@query()
def ordination_axes(spark, sf_dir):
    """Three principal coordinates of the Bray-Curtis distances, and what each explains."""
    d = materialise(ecology.bray_curtis(v.counts(spark, sf_dir)), "distances")
    axes = [f"{name}{i}" for name in ("axis", "share") for i in (1, 2, 3)]
    return rounded(ordination.principal_coordinates(d, 3), *axes, digits=5)


def indicator_sql(permutations: int, stat: str, extra: str = "") -> tuple:
    return (
        "sz AS (SELECT perm, grp, count(*) AS m FROM dealt GROUP BY 1, 2)",
        "per AS (SELECT *, s / m AS mean FROM (SELECT perm, otu, grp, CAST(sum(n) AS DOUBLE) AS s, CAST(sum(n * n) AS DOUBLE) AS q, count(*) AS c FROM counts JOIN dealt USING (sample) GROUP BY 1, 2, 3) JOIN sz USING (perm, grp))",
        f"st AS (SELECT perm, otu, grp, {stat} AS stat FROM per {extra} WINDOW o AS (PARTITION BY perm, otu))",
        "best AS (SELECT perm, otu, max(stat) AS stat, arg_max(grp, {'stat': stat, 'grp': grp}) AS grp FROM st GROUP BY 1, 2)",
        f"tests AS (SELECT r.otu, r.grp, r.stat, (count_if(b.stat >= r.stat - 1e-12) + 1) / {permutations + 1}.0 AS p FROM best r JOIN best b USING (otu) WHERE r.perm = 0 AND b.perm > 0 GROUP BY 1, 2, 3)",
    )


@query(
    "SELECT otu, grp, round(stat, 6) AS stat, round(p, 6) AS p, round(least(1, min(p * (SELECT count(*) FROM tests) / r) OVER (ORDER BY r DESC ROWS UNBOUNDED PRECEDING)), 6) AS fdr FROM (SELECT *, row_number() OVER (ORDER BY p, otu) AS r FROM tests)",
    v.COUNTS, v.METADATA, GROUPS, dealt_sql(999), *indicator_sql(999, "sqrt(mean / sum(mean) OVER o * c / m)"),
)
def indicator_species(spark, sf_dir):
    return rounded(ecology.indicators(v.counts(spark, sf_dir), groups(spark, sf_dir), 999), "stat", "p", "fdr")


@query(
    "SELECT otu, grp, round(stat, 6) AS stat, round(p, 6) AS p FROM tests",
    v.COUNTS, v.METADATA, GROUPS, dealt_sql(999),
    *indicator_sql(999, "(mean - sum(mean) OVER o / k) / sqrt(greatest(sum(q / m) OVER o / k - (sum(mean) OVER o / k) * (sum(mean) OVER o / k), 1e-12) * (k - 1))", ", (SELECT count(DISTINCT grp) AS k FROM g)"),
)
def phi_coefficients(spark, sf_dir):
    return rounded(ecology.indicators(v.counts(spark, sf_dir), groups(spark, sf_dir), 999, how="phi").drop("fdr"), "stat", "p")


@query(
    "SELECT a.sample AS s1, b.sample AS s2, round(sqrt(greatest(sum((a.u - b.u) * (a.u - b.u)) - pow(sum(a.u) - sum(b.u), 2) / count(*), 0)), 4) AS d FROM u a JOIN u b USING (otu) WHERE a.sample < b.sample GROUP BY 1, 2",
    v.COUNTS, "u AS (SELECT s.sample, o.otu, ln(coalesce(n, 0) + 1) AS u FROM (SELECT DISTINCT sample FROM counts) s, (SELECT DISTINCT otu FROM counts) o LEFT JOIN counts c ON c.sample = s.sample AND c.otu = o.otu)",
)
def aitchison(spark, sf_dir):
    return rounded(ecology.aitchison(v.counts(spark, sf_dir)), "d", digits=4)


EDGES = "edge AS (SELECT 'r' || ranks[1] AS e, 2.0 AS l, otu FROM ranks UNION ALL SELECT 'o' || otu, 1.0, otu FROM ranks)"


@query(
    "SELECT s1, s2, round(sum(l * abs(coalesce(a, 0) - coalesce(b, 0))) / sum(l * (coalesce(a, 0) + coalesce(b, 0))), 6) AS d FROM (SELECT p.s1, p.s2, e.l, x.m AS a, y.m AS b FROM (SELECT a.sample AS s1, b.sample AS s2 FROM (SELECT DISTINCT sample FROM counts) a JOIN (SELECT DISTINCT sample FROM counts) b ON a.sample < b.sample) p, (SELECT DISTINCT e, l FROM edge) e LEFT JOIN mass x ON x.sample = p.s1 AND x.e = e.e LEFT JOIN mass y ON y.sample = p.s2 AND y.e = e.e) GROUP BY 1, 2",
    v.COUNTS, v.RANKS, EDGES, "mass AS (SELECT e, sample, sum(n) / any_value(t) AS m FROM counts JOIN edge USING (otu) JOIN (SELECT sample, sum(n) AS t FROM counts GROUP BY 1) USING (sample) GROUP BY 1, 2)",
)
def weighted_unifrac(spark, sf_dir):
    r = v.ranks(spark, sf_dir)
    regions = r.groupBy(F.concat(F.lit("r"), F.get("ranks", F.lit(0))).alias("edge_id")).agg(F.collect_list("otu").alias("leaf_otus")).select("edge_id", F.lit(2.0).alias("length"), "leaf_otus")
    tips = r.select(F.concat(F.lit("o"), "otu").alias("edge_id"), F.lit(1.0).alias("length"), F.array("otu").alias("leaf_otus"))
    return rounded(ecology.unifrac(v.counts(spark, sf_dir), regions.unionByName(tips), weighted=True), "d")


@query(
    "SELECT grp, round(avg(x), 6) AS mean1, round(stddev(x), 6) AS sd1, round(avg(y), 6) AS mean2, round(stddev(y), 6) AS sd2 FROM (SELECT sample, CAST(sum(n) AS DOUBLE) AS x, CAST(count(*) AS DOUBLE) AS y FROM counts GROUP BY 1) JOIN g USING (sample) GROUP BY 1",
    v.COUNTS, v.METADATA, GROUPS,
)
def group_centres(spark, sf_dir):
    scores = v.counts(spark, sf_dir).groupBy("sample").agg(F.sum("n").cast("double").alias("axis1"), F.count("*").cast("double").alias("axis2"))
    return rounded(ecology.group_centres(scores, groups(spark, sf_dir)), "mean1", "sd1", "mean2", "sd2")


@query(
    f"SELECT 'permanova' AS test, CAST(df AS INTEGER) AS df, round(f, 6) AS f, round(r2, 6) AS r2, round({WITH_P}, 6) AS p FROM f WHERE perm = 0 UNION ALL SELECT 'dispersion', NULL, round(f, 6), NULL, round((SELECT (count_if(f >= (SELECT f FROM f2 WHERE perm = 0) - 1e-12) + 1) / (count(*) + 1) FROM f2 WHERE perm > 0), 6) FROM f2 WHERE perm = 0",
    v.COUNTS, v.METADATA, GROUPS, BRAY, CENTRES, dealt_sql(999), PERMANOVA, dealt_sql(999, "z", "dealt2"), DISPERSION.replace("per AS", "per2 AS").replace("FROM per ", "FROM per2 ").replace("f AS (SELECT perm, (b", "f2 AS (SELECT perm, (b").replace("dealt", "dealt2"),
)
def results_table(spark, sf_dir):
    """The tests of one distance in one table."""
    d, g = materialise(ecology.bray_curtis(v.counts(spark, sf_dir)), "distances"), groups(spark, sf_dir)
    out = ecology.results_table({"permanova": ecology.permanova(d, g, 999), "dispersion": ecology.dispersion(d, g, 999)})
    return rounded(out.drop("sig"), "f", "r2", "p")


@query()
def community_tests(spark, sf_dir):
    """PERMANOVA and dispersion for three distances of the filtered table."""
    return rounded(pipelines.community_tests(filtered(spark, sf_dir), groups(spark, sf_dir), 999), "f", "r2", "p")


@query()
def barcode_reference(spark, sf_dir):
    """A barcode-of-life dump, spelt from the parts, to reference records: representatives of each BIN under its taxonomy."""
    p = v.table(spark, sf_dir, "part")
    spell = lambda c: F.translate(F.md5(F.concat(F.lit(c), F.col("k"))), v.HEX, v.BASES)
    base = p.select(F.col("p_partkey").alias("n"), F.floor(F.col("p_partkey") / 4).alias("k"))
    whole = F.concat(spell("a"), spell("b"))
    changed = F.when(F.col("n") % 4 == 3, F.concat(F.left(whole, F.lit(40)), F.lit("ACGTACGT"), F.substring(whole, 49, 16))).otherwise(F.concat(F.left(whole, F.lit(9)), F.translate(F.substring(whole, 10, 1), "AC", "GT"), F.substring(whole, 11, 54)))
    dump = base.select(
        F.when(F.col("n") % 4 == 0, whole).otherwise(changed).alias("nucleotides"), F.concat(F.lit("id"), "n").alias("sequenceID"), F.lit("AB1").alias("genbank_accession"), F.concat(F.lit("BOLD:B"), "k").alias("bin_uri"),
        F.lit("").alias("identification_provided_by"), F.lit("COI-5P").alias("marker_codes"), *[F.lit(x).alias(f"{c}_name") for c, x in zip(("phylum", "class", "order", "family", "genus", "species"), ("Arthropoda", "Insecta", "", "", "", ""))],
    )
    return refdb.barcode_reference(dump, identity=0.95)


