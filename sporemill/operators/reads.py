"""Reads: reads(read_id, sample, seq, qual, ...). Filters, dereplication, counts, subsamples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import seq as s
from ..functions.order import numbered


def max_errors(reads: DataFrame, most: float = 1.0, length: int | None = None) -> DataFrame:
    """Reads of at most ``most`` expected errors, after a cut to ``length``; shorter ones go."""
    if length:
        reads = reads.where(F.length("seq") >= length).withColumn("seq", F.left("seq", F.lit(length))).withColumn("qual", F.left("qual", F.lit(length)))
    return reads.where(s.expected_errors(F.col("qual")) <= most)


def no_ambiguous(reads: DataFrame, run: int = 1) -> DataFrame:
    """Reads without ``run`` N in a row."""
    return reads.where(~F.col("seq").contains("N" * run))


def by_length(reads: DataFrame, least: int = 0, most: int | None = None) -> DataFrame:
    n = F.length("seq")
    return reads.where((n >= least) & ((n <= most) if most else F.lit(True)))


def tag_quality(reads: DataFrame, min_rq: float = 0.98, min_bq: float = 80) -> DataFrame:
    """Reads whose columns rq and bq reach both limits; a missing value fails."""
    return reads.where((F.col("rq") >= min_rq) & (F.col("bq") >= min_bq))


def long_reads(reads: DataFrame, least: int, min_average: float) -> DataFrame:
    return reads.where((F.length("seq") >= least) & (s.average_quality(F.col("qual")) >= min_average))


def dereplicate(reads: DataFrame) -> DataFrame:
    """(seq, size, read_id): identical sequences once, with the first read's id."""
    return reads.groupBy("seq").agg(F.count("*").alias("size"), F.min("read_id").alias("read_id"))


def relabel(seqs: DataFrame, prefix: str) -> DataFrame:
    """Adds id = prefix + rank by size, then sequence."""
    return numbered(seqs, "_r", F.desc("size"), F.asc("seq")).withColumn("id", F.concat(F.lit(prefix), F.col("_r").cast("string"))).drop("_r")


def sample_counts(reads: DataFrame) -> DataFrame:
    return reads.groupBy("sample").agg(F.count("*").alias("reads"))


def length_histogram(reads: DataFrame) -> DataFrame:
    return reads.groupBy(F.length("seq").alias("length")).agg(F.count("*").alias("reads"))


def length_stats(reads: DataFrame) -> DataFrame:
    """One row: count, mean, least, greatest, 5th percentile of the lengths (from the histogram, which is small)."""
    return length_histogram(reads).agg(
        F.sum("reads").alias("reads"), (F.sum(F.col("length") * F.col("reads")) / F.sum("reads")).alias("mean"), F.min("length").alias("least"), F.max("length").alias("greatest"),
        F.expr("percentile(length, 0.05, reads)").alias("p05"),
    )


def guess_length(reads: DataFrame, first: int = 50) -> DataFrame:
    """(source, length): the greatest length among the first reads, to the nearest ten (half to even)."""
    return reads.where(F.col("rec_no") < first).groupBy("source").agg((F.rint(F.max(F.length("seq")) / 10) * 10).cast("int").alias("length"))


def reasons(reads: DataFrame) -> DataFrame:
    """Run counters: reads by what became of them."""
    return reads.groupBy("reason").agg(F.count("*").alias("reads"))


def keep_samples(reads: DataFrame, names: DataFrame | None = None, least: int | None = None) -> DataFrame:
    """Reads of samples that are named or have ``least`` reads or more."""
    good = []
    if names is not None:
        good.append(names.select("sample"))
    if least is not None:
        good.append(sample_counts(reads).where(F.col("reads") >= least).select("sample"))
    keep = good[0] if len(good) == 1 else good[0].union(good[1])
    return reads.join(keep.distinct(), "sample", "left_semi")


def drop_samples(reads: DataFrame, names: DataFrame | None = None, most: int | None = None) -> DataFrame:
    """Reads without those of samples that are named or have ``most`` reads or fewer."""
    bad = []
    if names is not None:
        bad.append(names.select("sample"))
    if most is not None:
        bad.append(sample_counts(reads).where(F.col("reads") <= most).select("sample"))
    gone = bad[0] if len(bad) == 1 else bad[0].union(bad[1])
    return reads.join(gone.distinct(), "sample", "left_anti")


def draw(key: Column, seed: str) -> Column:
    """A number for each key and seed by which rows are drawn; the same in any run and any engine."""
    return F.md5(F.concat(key.cast("string"), F.lit(seed)))


def rarefy(reads: DataFrame, n: int, seed: str = "rarefy") -> DataFrame:
    """At most ``n`` reads of each sample, without replacement. Spark cuts each task to ``n`` a sample before it shuffles."""
    order = Window.partitionBy("sample").orderBy(draw(F.col("read_id"), seed), "read_id")
    return reads.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= n).drop("_r")


def subsample(rows: DataFrame, key: str, n: int, seed: str = "subsample") -> DataFrame:
    """``n`` rows, drawn evenly."""
    return rows.orderBy(draw(F.col(key), seed), key).limit(n)


def exact_barcodes(reads: DataFrame, barcodes: DataFrame) -> DataFrame:
    """Adds ``label`` of the barcode (label, barcode) that the read starts with, null where none does; longest first.

    An equi-join for each barcode length that occurs; the dictionary is small by nature and its size is left to Spark.
    """
    lengths = [r[0] for r in barcodes.select(F.length("barcode")).distinct().orderBy(F.length("barcode").desc()).collect()]
    out = reads.withColumn("label", F.lit(None).cast("string"))
    for n in lengths:
        own = barcodes.where(F.length("barcode") == n).groupBy("barcode").agg(F.min("label").alias("_label"))
        out = out.join(own, F.left("seq", F.lit(n)) == F.col("barcode"), "left").withColumn("label", F.coalesce("label", "_label")).drop("_label", "barcode")
    return out


def right_index(pairs: DataFrame, expected: str) -> DataFrame:
    """Pairs (title1, title2, ...) whose titles carry no index other than ``expected``; numbers are no index."""
    wrong = lambda c: F.coalesce(s.index_of(F.col(c)) != expected, F.lit(False))
    return pairs.where(~wrong("title1") & ~wrong("title2"))


def trim_three_prime(seqs: DataFrame, length: int, remove: DataFrame | None = None) -> DataFrame:
    """Sequences (id, seq) cut to ``length``, without the ids of ``remove``."""
    out = seqs.withColumn("seq", F.left("seq", F.lit(length)))
    return out if remove is None else out.join(remove.select("id"), "id", "left_anti")


def proper_reads(reads: DataFrame, least: int, partial: bool = False) -> DataFrame:
    """Reads with primers array<int> (positions of the forward and the reverse primer, -1 where missing): both found and
    ``least`` apart, or with ``partial`` one found in a read of that length."""
    f, r = F.get("primers", F.lit(0)), F.get("primers", F.lit(1))
    both = (f >= 0) & (r >= 0)
    ok = both & (r - f >= least)
    if partial:
        ok = ok | (((f >= 0) != (r >= 0)) & (F.length("seq") >= least))
    return reads.where(F.coalesce(ok, F.lit(False)))


def not_bad(reads: DataFrame, report: DataFrame, least: int) -> DataFrame:
    """Reads that an overlap report (read_id, status, length, data) calls NotBad, of this length or more; adds data."""
    good = report.where((F.col("status") == "NotBad") & (F.col("length") >= least)).select("read_id", "data")
    return reads.join(good, "read_id")


def distinct_ids(records: DataFrame, key: str = "id") -> DataFrame:
    """The records, after a check that no id repeats; raises with examples if one does."""
    twice = records.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").limit(5).collect()
    if twice:
        raise ValueError(f"ids that repeat: {[r[key] for r in twice]}")
    return records


def union_of(*tables: DataFrame) -> DataFrame:
    """Records of several sources in one table, whatever order their columns have; missing columns are null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out
