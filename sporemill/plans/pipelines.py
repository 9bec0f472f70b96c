"""Whole analyses, composed of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import seq
from ..functions.scratch import materialise
from ..operators import classify, cluster, demux, ecology, reads, simjoin, table, taxonomy, variants
from ..sources import scans, sinks


def unique_reads(good: DataFrame, max_errors: float) -> DataFrame:
    """Quality-filtered, dereplicated, without padding: (id, seq, size)."""
    clean = reads.max_errors(good, max_errors).withColumn("seq", seq.strip_padding(F.col("seq"))[0])
    return materialise(reads.dereplicate(clean).select(F.md5("seq").alias("id"), "seq", "size"), "uniques")


def one_strand(otus: DataFrame) -> DataFrame:
    return otus.join(simjoin.wrong_strand(otus.select("id", "seq"), otus.select("id", "size")), "id", "left_anti")


def finished(otus: DataFrame, good: DataFrame, prefix: str, identity: float) -> tuple[DataFrame, DataFrame]:
    """Relabelled (otu, seq, size) and the count table of all reads."""
    named = materialise(reads.relabel(otus.select("seq", "size"), prefix).select("id", "seq", "size"), "otus")
    counts = table.count_table(simjoin.map_reads(good.select("sample", "seq"), named.select("id", "seq"), identity))
    return named.withColumnRenamed("id", "otu"), counts


def cluster_reads(good: DataFrame, max_errors: float = 1.0, min_size: int = 2, identity: float = 0.97, reference: DataFrame | None = None, pre_denoise: bool = False) -> tuple[DataFrame, DataFrame]:
    """good(read_id, sample, seq, qual) to (otus, counts): filter, dereplicate, cluster, chimeras, strand, map.

    ``pre_denoise`` first joins sequences within five edits of a more abundant one (at 90 %), and clusters those.
    """
    uniques = unique_reads(good, max_errors).where(F.col("size") >= min_size)
    if pre_denoise:
        near = cluster.cluster(uniques, 0.9, most_edits=5)
        sums = near.join(uniques.select("id", "size"), "id").groupBy("centroid").agg(F.sum("size").alias("size"))
        uniques = materialise(uniques.drop("size").join(sums, F.col("id") == F.col("centroid")).select("id", "seq", "size"), "uniques")
    members = cluster.cluster(uniques, identity)
    sizes = members.join(uniques.select("id", "size"), "id").groupBy("centroid").agg(F.sum("size").alias("size"))
    otus = uniques.drop("size").join(sizes, F.col("id") == F.col("centroid")).select("id", "seq", "size")
    otus = materialise(cluster.without_chimeras(otus), "otus")
    if reference is not None:
        otus = cluster.without_chimeras(otus, parents=reference, min_divergence=1.0)
    return finished(one_strand(otus), good, "OTU", identity)


def denoise_reads(good: DataFrame, max_errors: float = 1.0, min_size: int = 8, identity: float = 0.97) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(variants, counts of variants, (variant, otu) by clustering the variants)."""
    uniques = unique_reads(good, max_errors).where(F.col("size") >= min_size)
    members = cluster.denoise(uniques, min_size=min_size)
    sizes = members.join(uniques.select("id", "size"), "id").groupBy("centroid").agg(F.sum("size").alias("size"))
    kept = uniques.drop("size").join(sizes, F.col("id") == F.col("centroid")).select("id", "seq", "size")
    asvs, counts = finished(one_strand(materialise(cluster.without_chimeras(kept, skew=16.0), "variants")), good, "ASV", identity)
    groups = cluster.cluster(asvs.select(F.col("otu").alias("id"), "seq", "size"), identity)
    return asvs, counts, groups.select(F.col("id").alias("asv"), F.col("centroid").alias("otu"))


def infer_reads(
    good: DataFrame, max_errors: float = 1.0, how: str = "sample", platform: str = "illumina", min_reads: int = 10, chimeras: str = "consensus", reference: DataFrame | None = None, identity: float = 0.97, **options
) -> dict[str, DataFrame]:
    """Variants by learnt error rates: good(read_id, sample, seq, qual) to variants(otu, seq, size), counts of all reads by
    variant, inferred(sample, seq, n), otus(otu, seq, size) by clustering the variants, their counts, and members(asv, otu).

    Reads lose padding and are filtered by expected errors and ambiguous bases, consensus reads ("pacbio") by their columns
    rq and bq; samples of fewer than ``min_reads`` reads go. ``how`` and ``platform`` are those of variants.infer_variants,
    ``chimeras`` is the mode of cluster.bimeras; with ``reference`` what two of its records explain goes too. Variants that are
    the other strand of a more abundant one go.
    """
    bare, qual = seq.strip_padding(F.col("seq"), F.col("qual"))
    stripped = good.withColumn("qual", qual).withColumn("seq", bare)
    clean = reads.tag_quality(stripped) if platform == "pacbio" else reads.max_errors(reads.no_ambiguous(stripped), max_errors)
    clean = materialise(clean.select("sample", "seq", "qual"), "filtered")
    clean = reads.drop_samples(clean, most=min_reads - 1)
    found, _ = variants.infer_variants(clean, how, platform, **options)
    kept = materialise(cluster.bimeras(found, chimeras, min_fold=3.5 if platform == "pacbio" else 1.5), "variants")
    asvs = kept.groupBy("seq").agg(F.sum("n").alias("size")).select(F.md5("seq").alias("id"), "seq", "size")
    if reference is not None:
        asvs = cluster.without_chimeras(materialise(asvs, "variants"), parents=reference, min_divergence=1.0)
    named, counts = finished(one_strand(materialise(asvs, "variants")), stripped, "ASV", 0.97)
    sized = named.select(F.col("otu").alias("id"), "seq", "size")
    groups = materialise(cluster.cluster(sized, identity), "members")
    sums = groups.join(sized.select("id", "size"), "id").groupBy("centroid").agg(F.sum("size").alias("size"))
    otus, otu_counts = finished(sized.drop("size").join(sums, F.col("id") == F.col("centroid")).select("id", "seq", "size"), stripped, "OTU", 0.97)
    names = sized.join(groups, "id").select(F.col("id").alias("asv"), "centroid").join(sized.select(F.col("id").alias("centroid"), "seq"), "centroid").join(otus.select("otu", "seq"), "seq")
    return {"variants": named, "counts": counts, "inferred": kept, "otus": otus, "otu_counts": otu_counts, "members": names.select("asv", "otu")}


def closed_reference(good: DataFrame, reference: DataFrame, max_errors: float = 1.0, min_size: int = 2, identity: float = 0.97) -> tuple[DataFrame, DataFrame]:
    """Counts by reference record, and the unique sequences that hit none."""
    uniques = cluster.without_chimeras(unique_reads(good, max_errors).where(F.col("size") >= min_size))
    hits = simjoin.best_hit(uniques.select("id", "seq"), reference.select("id", "seq"), identity)
    counts = table.count_table(simjoin.map_reads(good.select("sample", "seq"), reference.select("id", "seq").join(hits.select(F.col("target").alias("id")).distinct(), "id", "left_semi"), identity))
    return counts, uniques.join(hits.select(F.col("query").alias("id")), "id", "left_anti")


def clean_table(counts: DataFrame, mock_hits: DataFrame | None, mock_sample: str | None, rate: float | None = None, calculate: str = "all", auto_subtract: bool = False, **options) -> DataFrame:
    """The count table after the spike-in control: bleed rate measured unless given, cells cut, counts restored."""
    if mock_hits is not None and mock_sample is not None and (rate is None or auto_subtract):
        r = table.bleed_rates(table.normalise(counts), mock_hits.select("otu"), mock_sample)
        measured = table.bleed_filter_rate(r, calculate)
        subtract = int(r.first()["subtract"]) if auto_subtract else 0
        return table.filter_table(counts, measured if rate is None else rate, subtract_reads=subtract, **options)
    return table.filter_table(counts, rate or 0.0, **options)


def annotated(otus: DataFrame, counts: DataFrame, reference: DataFrame, cutoff: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(taxonomy, counts with taxonomy) of otus(otu, seq) against ref(ref, ranks, seq)."""
    tax = materialise(classify.hybrid(otus.select("otu", "seq"), reference, cutoff), "taxonomy")
    return tax, taxonomy.attach(counts, tax)


def demultiplexed(marked: DataFrame, label: str = "sample") -> dict[str, DataFrame]:
    """What a run of demultiplexing gives, from reads with reason: good reads, rejects, counters, reads per sample."""
    marked = materialise(marked, "marked")
    good = marked.where("reason is null").withColumn("sample", F.col(label)).drop("reason")
    return {"good": good, "rejects": marked.where("reason is not null"), "counters": reads.reasons(marked), "samples": reads.sample_counts(good)}


def single_reads(raw: DataFrame, forward: str, reverse: str, barcodes: list[tuple[str, str]], **options) -> dict[str, DataFrame]:
    """Single reads with barcodes: raw(read_id, seq, qual) of a FASTQ or SAM scan; options are those of demux.single_end."""
    return demultiplexed(demux.single_end(raw.where("seq is not null"), forward, reverse, barcodes, **options), "label")


def merged_pairs(pairs: DataFrame, length: int | None, min_length: int, rescue: bool) -> DataFrame:
    """Pairs without reason are merged and cut; those that have one keep it. All go through once: what found the reason costs
    more than the merging."""
    bare = pairs.withColumnRenamed("reason", "_why").withColumns({m: F.when(F.col("_why").isNull(), F.col(m)) for m in ("r1", "r2")})
    out = demux.merge_pairs(bare, min_length=min_length, rescue=rescue)
    out = out.withColumns({"merged": F.when(F.col("_why").isNull(), F.col("merged")), "reason": F.coalesce("_why", "reason")}).drop("_why")
    if length:
        out = out.withColumn("seq", F.left("seq", F.lit(length))).withColumn("qual", F.left("qual", F.lit(length)))
    return out


def barcoded_pairs(pairs: DataFrame, sheet: DataFrame, forward_barcodes: list[tuple[str, str]], reverse_barcodes: list[tuple[str, str]], forward: str, reverse: str, mismatches: int = 0, primer_mismatches: int = 2, length: int | None = None, min_length: int = 50, rescue: bool = False) -> dict[str, DataFrame]:
    """Pairs with a barcode in both mates: barcodes by the sheet(sample_id, for_label, rev_label), primers, merging."""
    p = demux.dual_barcodes(pairs, sheet, forward_barcodes, reverse_barcodes, mismatches).withColumnRenamed("reason", "_why")
    p = demux.strip_pair_primers(p, forward, reverse, primer_mismatches).withColumn("reason", F.coalesce("_why", "reason")).drop("_why")
    return demultiplexed(merged_pairs(p, length, min_length, rescue), "sample_id")


def folder_of_pairs(first: DataFrame, second: DataFrame, forward: str, reverse: str, mismatches: int = 2, need_primers: bool = True, length: int | None = None, min_length: int = 50, rescue: bool = False) -> dict[str, DataFrame]:
    """A folder of samples that are apart already: FASTQ scans of all R1 and all R2 files, samples by file name."""
    named = scans.folder_names(scans.pairs(first, second).withColumnRenamed("pair", "source")).drop("i5", "i7", "lane", "mate")
    named = named.where("r1 is not null and r2 is not null")
    if need_primers:
        named = demux.reorient_pairs(named, forward, reverse, mismatches).drop("reason")
    return demultiplexed(merged_pairs(demux.strip_pair_primers(named, forward, reverse, mismatches, need_primers), length, min_length, rescue))


def indexed_pairs(pairs: DataFrame, barcodes: list[tuple[str, str]], forward: str, reverse: str, mismatches: int = 1, primer_mismatches: int = 2, length: int | None = None, min_length: int = 50, rescue: bool = False) -> dict[str, DataFrame]:
    """Pairs whose barcode is a read of its own (column index)."""
    p = demux.match_index(pairs, barcodes, mismatches).withColumn("label", F.col("barcode.label")).drop("barcode")
    p = demux.strip_pair_primers(p, forward, reverse, primer_mismatches)
    return demultiplexed(merged_pairs(p.withColumn("reason", F.when(F.col("label").isNull(), "no_barcode").otherwise(F.col("reason"))), length, min_length, rescue), "label")


def consensus_reads(sam: DataFrame, barcodes: DataFrame, forward: str, reverse: str, mismatches: int = 2, min_length: int = 100, internal: tuple[str, str] | None = None) -> dict[str, DataFrame]:
    """Circular consensus reads of a SAM scan: barcode numbers to names, orientation, length."""
    named = scans.barcode_names(sam.where("reason is null").drop("reason").withColumn("read_id", F.col("zm")), barcodes)
    r = demux.orient_reads(named, forward, reverse, mismatches, internal)
    return demultiplexed(r.withColumn("reason", F.coalesce("reason", F.when(F.length("seq") < min_length, "too_short"))))


def nanopore_reads(raw: DataFrame, forward: str, reverse: str, mapping: DataFrame | None = None, least: int = 200, min_average: float = 10.0, mismatches: int = 4) -> dict[str, DataFrame]:
    """Long reads of run folders: names by folder, length and quality, orientation."""
    named = reads.long_reads(scans.run_folders(raw.where("reason is null").drop("reason"), mapping), least, min_average)
    return demultiplexed(demux.orient_reads(named, forward, reverse, mismatches))


def community_tests(counts: DataFrame, groups: DataFrame, permutations: int = 999) -> DataFrame:
    """(test, df, f, r2, p, sig): PERMANOVA and dispersion of groups(sample, grp) for every distance of a count table."""
    tests = {}
    for name, distance in (("bray-curtis", ecology.bray_curtis), ("jaccard", ecology.jaccard), ("aitchison", ecology.aitchison)):
        d = materialise(distance(counts), "distances")
        tests[f"permanova {name}"] = ecology.permanova(d, groups, permutations)
        tests[f"dispersion {name}"] = ecology.dispersion(d, groups, permutations)
    return ecology.results_table(tests)


def submission(good: DataFrame, biosamples: DataFrame, platform: dict[str, str], path: str) -> DataFrame:
    """Writes a FASTQ folder a sample, and returns the sheet that a repository asks for."""
    sinks.write_fastq_by_sample(good, path)
    return sinks.submission_sheet(good.select("sample").distinct(), biosamples, platform)
