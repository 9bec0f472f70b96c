"""The registered queries of the marker-gene operators, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import seq
from ..functions.scratch import materialise
from ..operators import cluster, demux, ecology, reads, simjoin, table, taxonomy
from . import views as v

Query = Callable[[SparkSession, str], DataFrame]
FLAGSHIP = "community_composition"
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
RATE = 0.005


def query(sql: str | None = None, *ctes: str):
    """Registers a query under its function's name, with its SQL over the given common table expressions."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = (f"WITH {', '.join(ctes)} " if ctes else "") + sql
        return f

    return add


NORM = "norm AS (SELECT otu, sample, CAST(round_even(n / sum(n) OVER (PARTITION BY sample) * 100000, 0) AS BIGINT) AS n FROM counts)"
KEPT = "kept AS (SELECT * FROM norm WHERE otu IN (SELECT otu FROM counts GROUP BY otu HAVING sum(n) >= 2))"
CLEAN = f"clean AS (SELECT otu, sample FROM (SELECT *, max(n) OVER (PARTITION BY otu) AS b FROM kept) WHERE n > 0 AND n >= b * CAST({RATE} AS DOUBLE))"
FINAL = "final AS (SELECT counts.* FROM counts JOIN clean USING (otu, sample))"
FILTERED = (v.COUNTS, NORM, KEPT, CLEAN, FINAL)


def filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table.filter_table(v.counts(spark, sf_dir), RATE)


def rank_sql(rank: str) -> str:
    return f"coalesce((SELECT any_value(substr(r, 3)) FROM unnest(ranks) AS t(r) WHERE starts_with(r, '{rank}:')), 'Unclassified')"


def summary_sql(source: str, ranks: str) -> str:
    each = " UNION ALL ".join(f"SELECT '{r}' AS rank, {rank_sql(r)} AS taxon, sample, n FROM j" for r in ranks)
    return (
        f", j AS (SELECT f.otu, sample, n, coalesce(ranks, []) AS ranks FROM {source} f LEFT JOIN ranks USING (otu)), e AS ({each}), "
        "s AS (SELECT rank, taxon, sample, CAST(sum(n) AS BIGINT) AS n FROM e GROUP BY ALL), ok AS (SELECT DISTINCT rank FROM s WHERE taxon <> 'Unclassified') "
        "SELECT rank, taxon, sample, n, round(n / sum(n) OVER (PARTITION BY rank, sample) * 100, 6) AS percent FROM s WHERE rank IN (SELECT rank FROM ok)"
    )


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query()
def community_composition(spark, sf_dir):
    """Index-bleed filter, then the share of every phylum in every sample."""
    return rounded(taxonomy.summarise(filtered(spark, sf_dir), v.ranks(spark, sf_dir), ("p",)), "percent")


ORACLE_SQL["community_composition"] = f"WITH {', '.join((*FILTERED, v.RANKS))}" + summary_sql("final", "p")


@query()
def taxonomy_summary(spark, sf_dir):
    return rounded(taxonomy.summarise(v.counts(spark, sf_dir), v.ranks(spark, sf_dir), ("k", "p", "c", "s")), "percent")


ORACLE_SQL["taxonomy_summary"] = f"WITH {v.COUNTS}, {v.RANKS}" + summary_sql("counts", "kpcs")


@query("SELECT otu, sample, n FROM final", *FILTERED)
def bleed_filter_max(spark, sf_dir):
    return filtered(spark, sf_dir)


def top_sql(share: float) -> str:
    return (
        f"SELECT otu, sample, n FROM (SELECT *, sum(CASE WHEN r <= k THEN n ELSE 0 END) OVER (PARTITION BY otu) AS b FROM (SELECT *, row_number() OVER (PARTITION BY otu ORDER BY n DESC, sample) AS r, "
        f"round_even((SELECT count(DISTINCT sample) FROM norm) * {share}, 0) AS k FROM norm)) WHERE n > 0 AND n >= b * CAST({RATE} AS DOUBLE)"
    )


@query(top_sql(0.25), v.COUNTS, NORM)
def bleed_filter_top25(spark, sf_dir):
    return table.bleed_filter(table.normalise(v.counts(spark, sf_dir)), RATE, "top25")


@query(top_sql(0.10), v.COUNTS, NORM)
def bleed_filter_top10(spark, sf_dir):
    return table.bleed_filter(table.normalise(v.counts(spark, sf_dir)), RATE, "top10")


@query(top_sql(0.05), v.COUNTS, NORM)
def bleed_filter_top5(spark, sf_dir):
    return table.bleed_filter(table.normalise(v.counts(spark, sf_dir)), RATE, "top5")


@query(f"SELECT otu, sample, n FROM (SELECT *, sum(n) OVER (PARTITION BY otu) AS b FROM norm) WHERE n > 0 AND n >= b * CAST({RATE} AS DOUBLE)", v.COUNTS, NORM)
def bleed_filter_sum(spark, sf_dir):
    return table.bleed_filter(table.normalise(v.counts(spark, sf_dir)), RATE, "sum")


RATES = f"""rates AS (
  SELECT sum(CASE WHEN m AND sample <> '{v.MOCK_SAMPLE}' THEN n ELSE 0 END) / sum(CASE WHEN m THEN n ELSE 0 END) AS into_samples,
    sum(CASE WHEN NOT m AND sample = '{v.MOCK_SAMPLE}' AND e > 0 THEN n ELSE 0 END) / sum(CASE WHEN sample = '{v.MOCK_SAMPLE}' THEN n ELSE 0 END) AS into_mock,
    coalesce(max(CASE WHEN NOT m AND sample = '{v.MOCK_SAMPLE}' AND e > 0 THEN n END), 0) AS subtract
  FROM (SELECT *, otu IN (SELECT otu FROM mocks) AS m, sum(CASE WHEN sample <> '{v.MOCK_SAMPLE}' THEN n ELSE 0 END) OVER (PARTITION BY otu) AS e FROM counts))"""


@query("SELECT round(into_samples, 6) AS into_samples, round(into_mock, 6) AS into_mock, subtract, ceil(greatest(into_samples, into_mock) * 1000) / 1000 AS rate FROM rates", v.COUNTS, v.MOCKS, RATES)
def bleed_rates(spark, sf_dir):
    r = table.bleed_rates(v.counts(spark, sf_dir), v.mock_otus(spark, sf_dir), v.MOCK_SAMPLE)
    return rounded(r.join(table.bleed_filter_rate(r)), "into_samples", "into_mock")


@query("SELECT otu, sample, n - 2 AS n FROM norm WHERE n - 2 > 0", v.COUNTS, NORM)
def subtract_counts(spark, sf_dir):
    return table.subtract(table.normalise(v.counts(spark, sf_dir)), 2)


@query(
    "SELECT a.sample, a.reads, a.otus_before, coalesce(b.k, 0) AS otus_after FROM (SELECT sample, CAST(sum(n) AS BIGINT) AS reads, count(*) AS otus_before FROM counts GROUP BY 1) a LEFT JOIN (SELECT sample, count(*) AS k FROM final GROUP BY 1) b USING (sample)",
    *FILTERED,
)
def sample_stats(spark, sf_dir):
    return table.sample_stats(v.counts(spark, sf_dir), filtered(spark, sf_dir))


@query("SELECT otu, sample, round(n / sum(n) OVER (PARTITION BY sample) * 100, 6) AS percent FROM counts", v.COUNTS)
def percent_of_sample(spark, sf_dir):
    return rounded(table.percent(v.counts(spark, sf_dir)), "percent")


@query(
    "SELECT otu, sample, round(CASE WHEN q - k * m * m > 0 THEN (n - m) / sqrt((q - k * m * m) / (k - 1)) ELSE 0 END, 5) AS value FROM (SELECT otu, sample, CAST(n AS DOUBLE) AS n, sum(CAST(n AS DOUBLE)) OVER w / k AS m, sum(CAST(n AS DOUBLE) * n) OVER w AS q, k FROM counts, (SELECT count(DISTINCT sample) AS k FROM counts) WINDOW w AS (PARTITION BY otu))",
    v.COUNTS,
)
def row_zscores(spark, sf_dir):
    c = v.counts(spark, sf_dir)
    return rounded(table.scale_rows(c, c), "value", digits=5)


@query("SELECT otu, sample, n FROM counts WHERE otu IN (SELECT otu FROM counts GROUP BY otu HAVING sum(n) >= 500 AND count(*) >= 20)", v.COUNTS)
def keep_otus(spark, sf_dir):
    return table.keep_otus(v.counts(spark, sf_dir), 500, 20)


@query("SELECT otu, sample, n FROM counts WHERE otu NOT IN (SELECT otu FROM mocks)", v.COUNTS, v.MOCKS)
def drop_otus(spark, sf_dir):
    return table.drop_otus(v.counts(spark, sf_dir), v.mock_otus(spark, sf_dir))


@query(f"SELECT DISTINCT otu FROM counts WHERE sample = '{v.MOCK_SAMPLE}' AND otu NOT IN (SELECT otu FROM mocks)", v.COUNTS, v.MOCKS)
def negative_control_otus(spark, sf_dir):
    c = v.counts(spark, sf_dir)
    return table.negative_otus(c, c.where(F.col("sample") == v.MOCK_SAMPLE).select("sample").distinct(), v.mock_otus(spark, sf_dir))


@query(
    "SELECT coalesce(name, otu) AS otu, sample, CAST(sum(n) AS BIGINT) AS n FROM counts LEFT JOIN (SELECT unnest(o) AS otu, 'cOTUs_' || array_to_string(o, '_') AS name FROM (SELECT list_sort(list(otu)) AS o FROM ranks WHERE len(ranks) >= 2 GROUP BY array_to_string(ranks, ',') HAVING count(*) > 1)) USING (otu) GROUP BY 1, 2",
    v.COUNTS, v.RANKS,
)
def collapse_taxonomy(spark, sf_dir):
    return taxonomy.collapse(v.counts(spark, sf_dir), v.ranks(spark, sf_dir), 2)


@query("SELECT array_to_string(ranks, ',') AS taxonomy, array_to_string(list_sort(list(otu)), ',') AS otus FROM ranks GROUP BY 1", v.RANKS)
def taxonomy_members(spark, sf_dir):
    return taxonomy.members(v.ranks(spark, sf_dir))


QIIME_SQL = """SELECT otu, CASE
  WHEN d <= 1 THEN 'k__' || coalesce(k, '') || '; p__; c__; o__; f__; g__; s__'
  WHEN d = 2 THEN 'k__' || coalesce(k, '') || '; p__' || coalesce(p, '')
  ELSE 'k__' || coalesce(k, '') || '; p__' || coalesce(p, '') || '; c__' || coalesce(c, '') END AS qiime
FROM (SELECT otu, CASE WHEN c IS NOT NULL THEN 3 WHEN p IS NOT NULL THEN 2 ELSE 1 END AS d, k, p, c FROM (
  SELECT otu, (SELECT any_value(substr(r, 3)) FROM unnest(ranks) AS t(r) WHERE starts_with(r, 'k:')) AS k, (SELECT any_value(substr(r, 3)) FROM unnest(ranks) AS t(r) WHERE starts_with(r, 'p:')) AS p,
    (SELECT any_value(substr(r, 3)) FROM unnest(ranks) AS t(r) WHERE starts_with(r, 'c:')) AS c FROM ranks))"""


@query(QIIME_SQL, v.RANKS)
def qiime_taxonomy(spark, sf_dir):
    return v.ranks(spark, sf_dir).select("otu", taxonomy.qiime(F.col("ranks")).alias("qiime"))


@query("SELECT otu, sample, n, coalesce(array_to_string(ranks, ','), 'No hit') AS taxonomy FROM counts LEFT JOIN ranks USING (otu) WHERE coalesce(array_to_string(ranks, ','), 'No hit') LIKE '%p:%'", v.COUNTS, v.RANKS)
def table_with_taxonomy(spark, sf_dir):
    tax = v.ranks(spark, sf_dir).select("otu", F.array_join("ranks", ",").alias("taxonomy"))
    return taxonomy.with_text(taxonomy.attach(v.counts(spark, sf_dir), tax), "p:")


TRAITS = "traits AS (SELECT 'NATION ' || n_nationkey AS taxon, 'guild' || (n_nationkey % 4) AS guild FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT r_name, 'wide' FROM region)"


@query(
    "SELECT otu, t.taxon, t.guild FROM ranks LEFT JOIN (SELECT otu, max_by({'taxon': taxon, 'guild': guild}, i) AS t FROM (SELECT otu, i, replace(substr(ranks[i], 3), '_', ' ') AS taxon FROM (SELECT otu, ranks, unnest(range(1, len(ranks) + 1)) AS i FROM ranks)) JOIN traits USING (taxon) GROUP BY otu) USING (otu)",
    v.RANKS, TRAITS,
)
def guild_lookup(spark, sf_dir):
    nation, region = v.table(spark, sf_dir, "nation"), v.table(spark, sf_dir, "region")
    traits = nation.where("n_nationkey % 2 = 0").select(F.concat(F.lit("NATION "), "n_nationkey").alias("taxon"), F.concat(F.lit("guild"), (F.col("n_nationkey") % 4).cast("string")).alias("guild"))
    return taxonomy.guilds(v.ranks(spark, sf_dir), traits.union(region.select("r_name", F.lit("wide"))))


HITS = """hits AS (
  SELECT 'P' || ps.l_partkey % 500 AS otu, ps.s AS pos, r.otu AS ref, r.ranks FROM (SELECT DISTINCT l_partkey, l_suppkey AS s FROM lineitem) ps JOIN ranks r ON r.otu = 'OTU' || ps.s)"""
LCA_SQL = """SELECT otu, ref, len(l) < m AS lca, array_to_string(l, ',') AS ranks FROM (
  SELECT otu, m, min_by(ref, pos) AS ref, list_filter(min_by(ranks, pos), lambda x: len(list_filter(list(ranks), lambda y: NOT list_contains(y, x))) = 0) AS l
  FROM (SELECT *, max(len(ranks)) OVER (PARTITION BY otu) AS m FROM once) WHERE len(ranks) = m GROUP BY otu, m)"""
ONCE = "once AS (SELECT otu, pos, any_value(ref) AS ref, any_value(ranks) AS ranks FROM hits GROUP BY otu, pos)"


@query(LCA_SQL, v.RANKS, HITS, ONCE)
def top_hits_lca(spark, sf_dir):
    line = v.table(spark, sf_dir, "lineitem").select(F.concat(F.lit("P"), (F.col("l_partkey") % 500).cast("string")).alias("q"), F.col("l_suppkey").alias("pos")).distinct()
    r = v.ranks(spark, sf_dir).withColumnRenamed("otu", "ref")
    hits = line.join(r, F.concat(F.lit("OTU"), "pos") == F.col("ref")).select(F.col("q").alias("otu"), "pos", F.lit(1.0).alias("pident"), "ref", "ranks")
    return taxonomy.top_hits_lca(hits).select("otu", "ref", "lca", F.array_join("ranks", ",").alias("ranks"))


@query("SELECT sample, count(DISTINCT otu) AS observed FROM counts GROUP BY 1", v.COUNTS)
def alpha_richness(spark, sf_dir):
    return ecology.richness(v.counts(spark, sf_dir))


PAIRS = "t AS (SELECT sample, sum(n) AS t, count(*) AS k FROM counts GROUP BY 1), x AS (SELECT a.sample AS s1, b.sample AS s2, sum(least(a.n, b.n)) AS m, count(*) AS c FROM counts a JOIN counts b USING (otu) WHERE a.sample < b.sample GROUP BY 1, 2)"


@query("SELECT a.sample AS s1, b.sample AS s2, round(1 - 2 * coalesce(m, 0) / (a.t + b.t), 6) AS d FROM t a JOIN t b ON a.sample < b.sample LEFT JOIN x ON s1 = a.sample AND s2 = b.sample", v.COUNTS, PAIRS)
def bray_curtis(spark, sf_dir):
    return rounded(ecology.bray_curtis(v.counts(spark, sf_dir)), "d")


@query("SELECT a.sample AS s1, b.sample AS s2, round(1 - coalesce(c, 0) / (a.k + b.k - coalesce(c, 0)), 6) AS d FROM t a JOIN t b ON a.sample < b.sample LEFT JOIN x ON s1 = a.sample AND s2 = b.sample", v.COUNTS, PAIRS)
def jaccard_distance(spark, sf_dir):
    return rounded(ecology.jaccard(v.counts(spark, sf_dir)), "d")


# ---- reads -----------------------------------------------------------------------------------------------------------

EE = "list_sum(list_transform(string_split(qual, ''), lambda c: pow(10, -(ascii(c) - 33) / 10)))"


@query(f"SELECT sample, count(*) AS reads FROM reads WHERE {EE} <= 1.0 GROUP BY 1", v.READS)
def max_errors(spark, sf_dir):
    return reads.sample_counts(reads.max_errors(v.reads(spark, sf_dir)))


@query(f"SELECT read_id, round({EE}, 6) AS ee, round(-10 * log10({EE} / length(qual)), 6) AS average FROM reads", v.READS)
def read_quality(spark, sf_dir):
    q = F.col("qual")
    return rounded(v.reads(spark, sf_dir).select("read_id", seq.expected_errors(q).alias("ee"), seq.average_quality(q).alias("average")), "ee", "average")


@query("SELECT seq, count(*) AS size, min(read_id) AS read_id FROM reads GROUP BY 1", v.READS)
def dereplicate(spark, sf_dir):
    return reads.dereplicate(v.reads(spark, sf_dir))


@query("SELECT 'ASV' || row_number() OVER (ORDER BY size DESC, seq) AS id, seq, size FROM (SELECT seq, count(*) AS size FROM reads GROUP BY 1)", v.READS)
def relabel(spark, sf_dir):
    return reads.relabel(reads.dereplicate(v.reads(spark, sf_dir)), "ASV").select("id", "seq", "size")


@query("SELECT length(seq) AS length, count(*) AS reads FROM reads GROUP BY 1", v.READS)
def length_histogram(spark, sf_dir):
    return reads.length_histogram(v.reads(spark, sf_dir))


@query("SELECT label, sample, count(*) AS reads FROM reads LEFT JOIN barcodes ON starts_with(seq, barcode) GROUP BY 1, 2", v.READS, v.BARCODES)
def exact_barcodes(spark, sf_dir):
    return reads.exact_barcodes(v.reads(spark, sf_dir), v.barcodes(spark, sf_dir)).groupBy("label", "sample").agg(F.count("*").alias("reads"))


@query(
    "SELECT read_id, reverse(translate(seq, 'ACGT', 'TGCA')) AS rc, substr(seq, 9, 40) AS cut, rpad(seq, 108, 'N') AS padded, rpad(qual, 108, 'I') AS padded_qual FROM reads",
    v.READS,
)
def read_projections(spark, sf_dir):
    s, q = seq.trim_or_pad(F.col("seq"), F.col("qual"), 108, pad=True)
    r = v.reads(spark, sf_dir)
    return r.select("read_id", seq.reverse_complement(F.col("seq")).alias("rc"), seq.cut(F.col("seq"), 8, 48).alias("cut"), s.alias("padded"), q.alias("padded_qual"))


@query("SELECT read_id, sample FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY md5(read_id || 'rarefy'), read_id) AS r FROM reads) WHERE r <= 100", v.READS)
def rarefy(spark, sf_dir):
    return reads.rarefy(v.reads(spark, sf_dir), 100).select("read_id", "sample")


@query("SELECT sample, count(*) AS reads FROM reads GROUP BY 1 HAVING count(*) >= 4500", v.READS)
def keep_samples(spark, sf_dir):
    return reads.sample_counts(reads.keep_samples(v.reads(spark, sf_dir), least=4500))


@query("SELECT sample, count(*) AS reads FROM reads GROUP BY 1 HAVING NOT (count(*) <= 4500 OR sample = 'S3')", v.READS)
def drop_samples(spark, sf_dir):
    names = spark.createDataFrame([("S3",)], "sample string")
    return reads.sample_counts(reads.drop_samples(v.reads(spark, sf_dir), names, 4500))


@query("SELECT title, regexp_extract(title, 'label=([^;]*)', 1) AS sample, CAST(regexp_extract(title, 'size=([^;]*)', 1) AS BIGINT) AS size FROM titles", v.TITLES)
def parse_titles(spark, sf_dir):
    t = F.col("title")
    return v.titles(spark, sf_dir).select("title", seq.sample_of(t).alias("sample"), seq.title_values(t)["size"].cast("long").alias("size"))


# ---- matching, clustering, statistics --------------------------------------------------------------------------------


def plate(spark: SparkSession, sf_dir: str) -> list[tuple[str, str]]:
    """The dozen barcodes of the reads view."""
    return [(r["label"], r["barcode"]) for r in v.barcodes(spark, sf_dir).orderBy("label").collect()]


def demultiplexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return demux.single_end(v.reads(spark, sf_dir), "GTGARTCATCGAATCTTTG", "TCCTCCGCTTATTGATATGC", plate(spark, sf_dir), barcode_mismatches=0, primer_mismatches=2, length=100)


@query("SELECT sample AS label, CAST(NULL AS VARCHAR) AS reason, count(*) AS reads, CAST(sum(length(seq) - 8 - 19 - 20) AS BIGINT) AS bases FROM reads GROUP BY 1", v.READS)
def demultiplex(spark, sf_dir):
    return demultiplexed(spark, sf_dir).groupBy("label", "reason").agg(F.count("*").alias("reads"), F.sum(F.length("seq")).alias("bases"))


def amplicons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct amplicons with their sizes, ids by sequence."""
    good = demultiplexed(spark, sf_dir).where("reason is null")
    return materialise(reads.dereplicate(good.select("read_id", "seq")).select(F.md5("seq").alias("id"), "seq", "size"), "amplicons")


@query()
def cluster_amplicons(spark, sf_dir):
    """Greedy centroid clusters at 97 % of all amplicons of two reads or more."""
    return cluster.cluster(amplicons(spark, sf_dir).where("size >= 2"))


@query()
def otu_table(spark, sf_dir):
    """All reads mapped to the centroids of the clusters, counted by sample."""
    good = materialise(demultiplexed(spark, sf_dir).where("reason is null").select("read_id", F.col("label").alias("sample"), "seq"), "demultiplexed")
    seqs = reads.dereplicate(good).select(F.md5("seq").alias("id"), "seq", "size")
    found = cluster.cluster(seqs.where("size >= 2")).select("centroid").distinct()
    otus = seqs.join(found, F.col("id") == F.col("centroid"), "left_semi").select("id", "seq")
    return table.count_table(simjoin.map_reads(good, otus))


@query()
def denoise_amplicons(spark, sf_dir):
    return cluster.denoise(amplicons(spark, sf_dir), min_size=4)


@query()
def chimera_check(spark, sf_dir):
    return cluster.chimeras(amplicons(spark, sf_dir).where("size >= 2"))


@query()
def curate_table(spark, sf_dir):
    """Daughters merged into parents, all OTUs of one last digit counting as similar."""
    c = v.counts(spark, sf_dir)
    alike = c.select("otu", F.regexp_extract("otu", "([0-9])$", 1).alias("grp")).distinct()
    return cluster.curate(c, None, min_cooccurrence=0.9, min_ratio=0.5, alike=alike)[0]


def groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.metadata(spark, sf_dir).where("treatment <> 'no_data'").select("sample", F.col("treatment").alias("grp"))


UNIFRAC_SQL = """, edge AS (
  SELECT 'r' || r AS edge_id, 2.0 AS length, otu FROM (SELECT otu, ranks[1] AS r FROM ranks) UNION ALL
  SELECT 'o' || otu, 1.0, otu FROM ranks),
p AS (SELECT DISTINCT edge_id, length, sample FROM counts JOIN edge USING (otu)),
own AS (SELECT sample, sum(length) AS o FROM p GROUP BY 1),
x AS (SELECT a.sample AS s1, b.sample AS s2, sum(a.length) AS x FROM p a JOIN p b USING (edge_id) WHERE a.sample < b.sample GROUP BY 1, 2)
SELECT a.sample AS s1, b.sample AS s2, round((a.o + b.o - 2 * coalesce(x, 0)) / (a.o + b.o - coalesce(x, 0)), 6) AS d
FROM own a JOIN own b ON a.sample < b.sample LEFT JOIN x ON s1 = a.sample AND s2 = b.sample"""


@query()
def unifrac(spark, sf_dir):
    """Unweighted, on a tree whose edges are the regions and the OTUs."""
    r = v.ranks(spark, sf_dir)
    regions = r.groupBy(F.concat(F.lit("r"), F.get("ranks", F.lit(0))).alias("edge_id")).agg(F.collect_list("otu").alias("leaf_otus")).select("edge_id", F.lit(2.0).alias("length"), "leaf_otus")
    tips = r.select(F.concat(F.lit("o"), "otu").alias("edge_id"), F.lit(1.0).alias("length"), F.array("otu").alias("leaf_otus"))
    return rounded(ecology.unifrac(v.counts(spark, sf_dir), regions.unionByName(tips)), "d")


ORACLE_SQL["unifrac"] = f"WITH {v.COUNTS}, {v.RANKS}" + UNIFRAC_SQL

from . import classify_queries, distant_queries, longread_queries, read_queries, table_queries, variant_queries  # noqa: E402, F401  (they register themselves)
