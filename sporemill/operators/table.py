"""Algebra of long count tables: counts(otu, sample, n), n > 0 only.

Every function takes and returns DataFrames. Sums are taken before shuffles by Spark's partial aggregation; totals of
samples are small (a row a sample) and join back by Spark's own choice of join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What each bleed threshold sums: the share of the samples with the most reads, or None for the maximum and 1 for all.
THRESHOLDS = {"max": None, "sum": 1.0, "top25": 0.25, "top10": 0.10, "top5": 0.05}


def natural_key(name: Column) -> Column:
    """A key that sorts names with their numbers as numbers: OTU2 before OTU10."""
    parts = F.regexp_extract_all(name, F.lit(r"(\d+|\D+)"), F.lit(0))
    return F.transform(parts, lambda t: F.when(t.rlike(r"^\d+$"), F.lpad(t, 20, "0")).otherwise(t))


def count_table(mapped: DataFrame) -> DataFrame:
    """Reads mapped to OTUs (otu, sample) to counts; unmapped reads have a null otu."""
    return mapped.where("otu is not null").groupBy("otu", "sample").agg(F.count("*").alias("n"))


def from_wide(wide: DataFrame, otu: str, taxonomy: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """A wide OTU table to counts, and its trailing taxonomy column as (otu, taxonomy)."""
    samples = [c for c in wide.columns if c not in (otu, taxonomy)]
    quoted = [F.col(f"`{c}`").cast("double").alias(c) for c in samples]
    long = wide.select(F.col(f"`{otu}`").alias("otu"), *quoted).unpivot("otu", samples, "sample", "n")
    counts = long.where("n > 0").select("otu", "sample", F.col("n").cast("long").alias("n"))
    return counts, wide.select(F.col(f"`{otu}`").alias("otu"), F.col(f"`{taxonomy}`").alias("taxonomy")) if taxonomy else None


def to_wide(counts: DataFrame, samples: list[str] | None = None, value: str = "n") -> DataFrame:
    """Counts to a wide table, samples in natural order unless given, zero where there is no count."""
    if samples is None:
        samples = [r["sample"] for r in counts.select("sample").distinct().orderBy(natural_key(F.col("sample"))).collect()]
    return counts.groupBy("otu").pivot("sample", samples).agg(F.sum(value)).na.fill(0)


def totals(counts: DataFrame, by: str) -> DataFrame:
    return counts.groupBy(by).agg(F.sum("n").alias("total"))


def sample_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """(sample, reads, otus_before, otus_after)."""
    a = before.groupBy("sample").agg(F.sum("n").alias("reads"), F.count_if(F.col("n") > 0).alias("otus_before"))
    b = after.groupBy("sample").agg(F.count_if(F.col("n") > 0).alias("otus_after"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return a.join(b, "sample", "full_outer").select("sample", *map(zero, ("reads", "otus_before", "otus_after")))


def normalise(counts: DataFrame, scale: int = 100_000) -> DataFrame:
    """n as a share of the sample's reads times ``scale``, rounded half to even; zeros stay in, as cells that vanish."""
    t = totals(counts, "sample")
    return counts.join(t, "sample").select("otu", "sample", F.rint(F.col("n") / F.col("total") * scale).cast("long").alias("n"))


def bleed_rates(counts: DataFrame, mock_otus: DataFrame, mock_sample: str) -> DataFrame:
    """One row (into_samples, into_mock, subtract).

    into_samples: the mock OTUs' reads outside the mock sample over all their reads. into_mock: reads of other OTUs in
    the mock sample over all its reads; OTUs that occur in the mock sample alone are taken for chimeras and left out of
    the numerator. subtract: the largest such count.
    """
    is_mock = mock_otus.select("otu", F.lit(True).alias("mock")).distinct()
    spread = counts.groupBy("otu").agg(F.sum(F.when(F.col("sample") != mock_sample, F.col("n")).otherwise(0)).alias("elsewhere"))
    c = counts.join(is_mock, "otu", "left").join(spread, "otu").withColumn("mock", F.coalesce("mock", F.lit(False)))
    here, n = F.col("sample") == mock_sample, F.col("n")
    stray = here & ~F.col("mock") & (F.col("elsewhere") > 0)
    pick = lambda cond: F.coalesce(F.sum(F.when(cond, n)), F.lit(0))
    return c.agg(
        (pick(F.col("mock") & ~here) / pick(F.col("mock"))).alias("into_samples"),
        (pick(stray) / pick(here)).alias("into_mock"),
        F.coalesce(F.max(F.when(stray, n)), F.lit(0)).alias("subtract"),
    )


def bleed_filter_rate(rates: DataFrame, calculate: str = "all") -> DataFrame:
    """One row (rate): the larger rate, or the one into the mock alone ("in"), rounded up to three decimals."""
    worst = F.greatest("into_samples", "into_mock") if calculate == "all" else F.col("into_mock")
    return rates.select((F.ceil(worst * 1000) / 1000).alias("rate"))


def bleed_filter(counts: DataFrame, rate: float | DataFrame, threshold: str = "max", n_samples: int | None = None) -> DataFrame:
    """Drops cells below ``rate`` times the OTU's base: its maximum, its sum, or the sum over its top samples.

    A share of the samples is rounded half to even, over ``n_samples`` (the number of samples that occur by default).
    ``rate`` is a number or a one-row table (rate).
    """
    share = THRESHOLDS[threshold]
    of = Window.partitionBy("otu")
    if share is None:
        base = F.max("n").over(of)
    elif share == 1.0:
        base = F.sum("n").over(of)
    else:
        if n_samples is None:
            n_samples = counts.select("sample").distinct().count()
        counts = counts.withColumn("_r", F.row_number().over(of.orderBy(F.desc("n"), "sample")))
        base = F.sum(F.when(F.col("_r") <= F.rint(F.lit(n_samples * share)), F.col("n")).otherwise(0)).over(of)
    counts = counts.withColumn("_base", base)
    if isinstance(rate, DataFrame):
        counts = counts.join(F.broadcast(rate.select(F.col("rate").alias("_rate"))))  # one row
    else:
        counts = counts.withColumn("_rate", F.lit(float(rate)))
    return counts.where((F.col("n") > 0) & (F.col("n") >= F.col("_base") * F.col("_rate"))).select("otu", "sample", "n")


def subtract(counts: DataFrame, amount: int) -> DataFrame:
    """Takes ``amount`` from every cell; what reaches zero is gone."""
    return counts.withColumn("n", F.col("n") - amount).where("n > 0")


def keep_otus(counts: DataFrame, min_reads: int = 2, min_samples: int = 1) -> DataFrame:
    """OTUs with enough reads over all samples, in enough samples."""
    good = counts.groupBy("otu").agg(F.sum("n").alias("r"), F.count("*").alias("s")).where((F.col("r") >= min_reads) & (F.col("s") >= min_samples))
    return counts.join(good.select("otu"), "otu", "left_semi")


def drop_otus(counts: DataFrame, names: DataFrame) -> DataFrame:
    return counts.join(names.select("otu"), "otu", "left_anti")


def drop_samples(counts: DataFrame, names: DataFrame) -> DataFrame:
    return counts.join(names.select("sample"), "sample", "left_anti")


def restore(raw: DataFrame, surviving: DataFrame) -> DataFrame:
    """The original counts of the cells that survive."""
    return raw.join(surviving.select("otu", "sample"), ["otu", "sample"], "left_semi")


def presence(counts: DataFrame) -> DataFrame:
    return counts.withColumn("n", F.lit(1).cast("long"))


def filter_table(raw: DataFrame, rate: float | DataFrame, min_reads: int = 2, min_samples: int = 1, threshold: str = "max", subtract_reads: int = 0, scale: int = 100_000) -> DataFrame:
    """The clean-up of a count table: normalise (totals taken first), drop rare OTUs, cut index bleed, subtract, ask for
    enough samples, and give the surviving cells their original counts."""
    norm = keep_otus(raw, min_reads).select("otu", "sample").join(normalise(raw, scale), ["otu", "sample"])
    clean = bleed_filter(norm, rate, threshold, raw.select("sample").distinct().count() if threshold.startswith("top") else None)
    if subtract_reads:
        clean = subtract(clean, subtract_reads)
    return restore(raw, keep_otus(clean, 0, min_samples))


def percent(counts: DataFrame) -> DataFrame:
    """(otu, sample, percent) of the sample's reads."""
    t = totals(counts, "sample")
    return counts.join(t, "sample").select("otu", "sample", (F.col("n") / F.col("total") * 100).alias("percent"))


def rate_normalise(counts: DataFrame, given: DataFrame, scale: float = 1.0) -> DataFrame:
    """n over totals supplied as (sample, total), times ``scale``, rounded half to even."""
    return counts.join(given, "sample").select("otu", "sample", F.rint(F.col("n") / F.col("total") * scale).cast("long").alias("n"))


def scale_rows(counts: DataFrame, samples: DataFrame, how: str = "zscore") -> DataFrame:
    """Each OTU's row over all ``samples`` (zeros included): z-score, or (x - min) / (max - min) for "standard"."""
    k = samples.select("sample").distinct().agg(F.count("*").alias("k"))
    c = counts.join(F.broadcast(k))  # one row
    of = Window.partitionBy("otu")
    n, zeros = F.col("n").cast("double"), F.count("*").over(of) < F.col("k")
    if how == "standard":
        low, high = F.when(zeros, 0.0).otherwise(F.min(n).over(of)), F.max(n).over(of)
        value = F.when(high > low, (n - low) / (high - low)).otherwise(0.0)
    else:
        mean = F.sum(n).over(of) / F.col("k")
        var = (F.sum(n * n).over(of) - F.col("k") * mean * mean) / (F.col("k") - 1)
        value = F.when(var > 0, (n - mean) / F.sqrt(var)).otherwise(0.0)
    return c.select("otu", "sample", value.alias("value"))


def mock_error(counts: DataFrame, hits: DataFrame, mock_sample: str) -> DataFrame:
    """One row (error_percent) of the mock sample from best hits (otu, length, diffs); an OTU without a hit is all wrong."""
    c = counts.where(F.col("sample") == mock_sample).join(hits, "otu", "left")
    length = F.coalesce("length", F.lit(1))
    wrong = F.coalesce("diffs", length)
    return c.agg((F.sum(wrong * F.col("n")) / F.sum(length * F.col("n")) * 100).alias("error_percent"))


def classify_mock_hits(hits: DataFrame, abundance: DataFrame) -> DataFrame:
    """Best OTU of each mock member from hits (otu, mock, pident, length): (mock, otu, pident, class).

    The three most abundant OTUs that hit a member compete by abundance * identity * length. class: "hit" from 97 %,
    "variant" from 95 %, "chimera" below.
    """
    by_mock = Window.partitionBy("mock")
    h = hits.join(abundance.select("otu", F.col("total").alias("size")), "otu")
    h = h.withColumn("_a", F.row_number().over(by_mock.orderBy(F.desc("size"), F.desc("pident"), "otu"))).where("_a <= 3")
    score = F.col("size") * F.col("pident") * F.col("length")
    h = h.withColumn("_b", F.row_number().over(by_mock.orderBy(score.desc(), "otu"))).where("_b = 1")
    kind = F.when(F.col("pident") >= 97, "hit").when(F.col("pident") >= 95, "variant").otherwise("chimera")
    return h.select("mock", "otu", "pident", kind.alias("class"))


def missing_mocks(mock: DataFrame, classified: DataFrame) -> DataFrame:
    return mock.select("mock").distinct().join(classified.select("mock"), "mock", "left_anti")


def rename_mocks(counts: DataFrame, classified: DataFrame) -> DataFrame:
    """Display names: <mock>_pident=<id>_<otu>, with _suspect_mock_chimera or _variant after OTUs below 97 %."""
    suffix = F.when(F.col("class") == "chimera", "_suspect_mock_chimera").when(F.col("class") == "variant", "_suspect_mock_variant").otherwise("")
    name = F.concat("mock", F.lit("_pident="), F.format_string("%.1f", F.col("pident").cast("double")), F.lit("_"), "otu", suffix)
    names = classified.select(F.col("otu"), name.alias("shown"))
    return counts.join(names, "otu", "left").select(F.coalesce("shown", "otu").alias("otu"), "sample", "n")


def negative_otus(counts: DataFrame, negatives: DataFrame, mock_otus: DataFrame) -> DataFrame:
    """OTUs that occur in the negative samples, mock members aside."""
    seen = counts.join(negatives.select("sample"), "sample", "left_semi").select("otu").distinct()
    return seen.join(mock_otus.select("otu"), "otu", "left_anti")


def treatments(samples: DataFrame, columns: list[str]) -> list[str]:
    """The metadata columns worth testing: more than one level besides no_data."""
    levels = samples.agg(*[F.count_distinct(F.when(F.col(c) != "no_data", F.col(c))).alias(c) for c in columns]).first()
    return [c for c in columns if levels[c] > 1]


def keep_rich_samples(counts: DataFrame, min_taxa: int) -> DataFrame:
    """Samples with ``min_taxa`` OTUs or more; then OTUs with more than one read left."""
    rich = counts.groupBy("sample").agg(F.count_distinct("otu").alias("k")).where(F.col("k") >= min_taxa)
    c = counts.join(rich.select("sample"), "sample", "left_semi")
    return c.join(totals(c, "otu").where("total > 1").select("otu"), "otu", "left_semi")
