"""Scans: sequence files, sheets, count tables, hit and classifier results, as DataFrames.

All but FASTQ go through Spark's own readers, so any path that Spark can open works; FASTQ is listed by Spark and read in byte
ranges through ``open`` or Arrow's file systems. Bad rows are kept with a reason where the
format allows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import packed, seq
from ..functions.scratch import materialise
from ..operators import taxonomy
from . import ranges


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """(source, id, description, seq); the record separator is a line that begins with >."""
    raw = spark.read.option("lineSep", "\n>").text(path).select(F.col("_metadata.file_path").alias("source"), F.regexp_replace("value", "^>", "").alias("v"))
    head = F.regexp_replace(F.substring_index("v", "\n", 1), r"\r$", "")
    # the rest is cut off by its place: a pattern costs far more on each record
    body = F.when(F.instr("v", "\n") > 0, F.substring("v", F.instr("v", "\n") + 1, F.length("v"))).otherwise(F.lit(""))
    body = F.regexp_replace(F.replace(body, F.lit("\n"), F.lit("")), r"\s+", "")
    return raw.where("trim(v) <> ''").select("source", F.split(head, r"\s+").getItem(0).alias("id"), head.alias("description"), body.alias("seq"))


def fastq(spark: SparkSession, path: str, numbered: bool = True, range_bytes: int = ranges.RANGE) -> DataFrame:
    """(source, rec_no, read_id, title, seq, qual, reason) of four-line FASTQ, plain, gzip or block gzip.

    Plain files and block gzip are read in byte ranges, other gzip as one piece a file; records are not shuffled. Their
    numbers within a file follow from the records of each range, counted in a pass before; without ``numbered`` there is
    no such pass and no rec_no. The quality may begin with @ without harm. reason: malformed, or null.
    """
    cut = ranges.ranges_of(spark, path, range_bytes)
    if numbered:
        sizes = materialise(ranges.counts(cut), "range-sizes")  # a row a range
        before = F.coalesce(F.sum("n").over(Window.partitionBy("source").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        cut = ranges.spread(sizes.withColumn("first", before))
    r = ranges.records(cut).withColumns({c: F.rtrim(c, F.lit("\r")) for c in ("h", "seq", "plus", "qual")}).withColumnRenamed("i", "rec_no")
    r = r.where("h <> '' or seq is not null")
    good = F.startswith("h", F.lit("@")) & F.startswith("plus", F.lit("+")) & (F.length("seq") == F.length("qual"))
    title = F.regexp_replace("h", "^@", "")
    reason = F.when(F.coalesce(good, F.lit(False)), None).otherwise("malformed").cast("string")
    return r.select("source", *["rec_no"] * numbered, F.split(title, r"\s+").getItem(0).alias("read_id"), title.alias("title"), "seq", "qual", reason.alias("reason"))


def pairs(first: DataFrame, second: DataFrame, index: DataFrame | None = None, source_key=lambda c: F.regexp_replace(c, "_(R[12]|I1)(?=[_.])", "")) -> DataFrame:
    """Records of mates by file pair and number: (pair, rec_no, read_id, r1, r2[, index]); nulls where a mate lacks."""
    def side(df: DataFrame, name: str) -> DataFrame:
        # by its estimate a scan is as small as its list of ranges, and would be broadcast whole
        return df.select(source_key(F.col("source")).alias("pair"), "rec_no", F.col("read_id").alias(f"_{name}"), F.struct("seq", "qual").alias(name)).hint("merge")

    out = side(first, "r1").join(side(second, "r2"), ["pair", "rec_no"], "full_outer")
    if index is not None:
        out = out.join(side(index, "i1"), ["pair", "rec_no"], "left").withColumn("index", F.col("i1.seq")).drop("i1", "_i1")
    return out.withColumn("read_id", F.coalesce("_r1", "_r2")).drop("_r1", "_r2")


def mates(spark: SparkSession, first: str, second: str, index: str | None = None, source_key=lambda c: F.regexp_replace(c, "_(R[12]|I1)(?=[_.])", ""), range_bytes: int = ranges.RANGE) -> DataFrame:
    """The rows of ``pairs`` of scans of these paths, without a shuffle of records: the files of a pair are read in step, each
    task from one range's beginning to the next one's. A pair of files has one file of each mate; where it has several, they
    count as one after another by name."""
    paths = [first, second, *([index] if index else [])]
    cut = None
    for m, path in enumerate(paths):
        one = ranges.counts(ranges.ranges_of(spark, path, range_bytes)).withColumn("mate", F.lit(m))
        cut = one if cut is None else cut.unionByName(one)
    sizes = materialise(cut.withColumn("pair", source_key(F.col("source"))).drop("source"), "range-sizes")
    work = materialise(ranges.pieces_of(sizes), "range-pairs")
    r = ranges.spread(work).mapInArrow(ranges.read_mates(len(paths)), ranges.mates_schema(len(paths)))
    there, bare = {}, lambda c: F.rtrim(c, F.lit("\r"))
    for m in range(len(paths)):
        # a blank line at a file's end is no record
        there[m] = (bare(f"h{m}") != "") | F.col(f"s{m}").isNotNull()
    mate = lambda m: F.when(there[m], F.struct(bare(f"s{m}").alias("seq"), bare(f"q{m}").alias("qual")))
    name = lambda m: F.when(there[m], F.split(F.regexp_replace(bare(f"h{m}"), "^@", ""), r"\s+").getItem(0))
    some = F.coalesce(there[0], F.lit(False)) | F.coalesce(there[1], F.lit(False))
    out = {"r1": mate(0), "r2": mate(1)} | ({"index": F.when(there[2], bare("s2"))} if index else {})
    return r.where(some).select("pair", "rec_no", F.coalesce(name(0), name(1)).alias("read_id"), *[c.alias(n) for n, c in out.items()])


def unpaired(paired: DataFrame) -> DataFrame:
    """(pair, missing_r1, missing_r2) of the file pairs that do not match; empty when all is well."""
    n = paired.groupBy("pair").agg(F.count_if(F.col("r1").isNull()).alias("missing_r1"), F.count_if(F.col("r2").isNull()).alias("missing_r2"))
    return n.where("missing_r1 > 0 or missing_r2 > 0")


def fasta_with_qual(spark: SparkSession, fasta_path: str, qual_path: str) -> DataFrame:
    """(id, seq, qual) from sequences and space-separated scores; they are shuffled compressed."""
    raw = spark.read.option("lineSep", "\n>").text(qual_path).select(F.regexp_replace("value", "^>", "").alias("v")).where("trim(v) <> ''")
    scores = F.when(F.instr("v", "\n") > 0, F.substring("v", F.instr("v", "\n") + 1, F.length("v"))).otherwise(F.lit(""))
    q = raw.select(F.split(F.substring_index("v", "\n", 1), r"\s+").getItem(0).alias("id"), seq.phred_text(scores).alias("qual"))
    files = spark.read.format("binaryFile").load([fasta_path, qual_path]).agg(F.sum("length")).first()[0]
    return packed.joined(fasta(spark, fasta_path).select("id", "seq"), q, 6 * int(files or 0))  # as if all were gzip


def sam(spark: SparkSession, path: str) -> DataFrame:
    """SAM text of circular consensus reads: (source, title, seq, qual, zm, rq, bc_forward, bc_reverse, bq, reason)."""
    f = F.split("value", "\t")
    raw = spark.read.text(path).where("not startswith(value, '@') and value <> ''").select(F.col("_metadata.file_path").alias("source"), f.alias("f"))
    tags = F.map_from_entries(F.transform(F.slice("f", 12, 1000), lambda x: F.struct(F.substring_index(x, ":", 1).alias("k"), F.regexp_extract(x, "^[^:]*:[^:]*:(.*)$", 1).alias("v"))))
    r = raw.withColumn("t", tags)
    bc = F.split(F.col("t")["bc"], ",")
    ok = F.col("t")["zm"].isNotNull() & F.col("t")["rq"].isNotNull() & F.col("t")["bc"].isNotNull() & F.col("t")["bq"].isNotNull()
    return r.select(
        "source", F.get("f", F.lit(0)).alias("title"), F.get("f", F.lit(9)).alias("seq"), F.get("f", F.lit(10)).alias("qual"), F.col("t")["zm"].alias("zm"), F.col("t")["rq"].cast("double").alias("rq"),
        F.get(bc, F.lit(1)).cast("int").alias("bc_forward"), F.get(bc, F.lit(2)).cast("int").alias("bc_reverse"), F.col("t")["bq"].cast("int").alias("bq"), F.when(~ok, "bad_parse").alias("reason"),
    )


def barcode_names(reads: DataFrame, barcodes: DataFrame) -> DataFrame:
    """Adds sample from barcode numbers: barcodes(pos, label); "f", or "f-r" where the two ends differ."""
    f, r = (barcodes.select(F.col("pos").alias(f"_p{i}"), F.col("label").alias(f"_l{i}")) for i in "fr")
    j = reads.join(f, F.col("bc_forward") == F.col("_pf"), "left").join(r, F.col("bc_reverse") == F.col("_pr"), "left")
    return j.withColumn("sample", F.when(F.col("_lf") == F.col("_lr"), F.col("_lf")).otherwise(F.concat_ws("-", "_lf", "_lr"))).drop("_pf", "_lf", "_pr", "_lr")


def sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """(sample_id, for_barcode, for_primer, rev_barcode, rev_primer, other columns), columns found by name.

    A barcode that the primer contains is cut off, with what stands before it.
    """
    raw = spark.read.option("header", True).option("sep", "\t").csv(path)
    names = {c.lstrip("#").lower(): c for c in raw.columns}
    get = lambda n: F.col(f"`{names[n]}`") if n in names else F.lit(None).cast("string")
    bare = lambda p, b: F.when(b.isNotNull() & (b != "") & (F.instr(p, b) > 0), F.substring(p, F.instr(p, b) + F.length(b), F.length(p))).otherwise(p)
    fb, rb, fp, rp = get("barcodesequence"), get("revbarcodesequence"), get("linkerprimersequence"), get("reverseprimer")
    used = {"sampleid", "barcodesequence", "revbarcodesequence", "linkerprimersequence", "reverseprimer"}
    rest = [F.col(f"`{c}`") for n, c in names.items() if n not in used]
    return raw.select(get("sampleid").alias("sample_id"), fb.alias("for_barcode"), bare(fp, fb).alias("for_primer"), rb.alias("rev_barcode"), bare(rp, rb).alias("rev_primer"), *rest).where("sample_id is not null")


def duplicates(df: DataFrame, *columns: str) -> DataFrame:
    """Values that occur more than once; empty when all is well."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def uc(spark: SparkSession, path: str) -> DataFrame:
    """The ten-column .uc format to (query, target, pident); target and identity null where there is no hit."""
    c = spark.read.option("sep", "\t").csv(path, schema=", ".join(f"c{i} string" for i in range(10)))
    none = lambda x: F.when(x != "*", x)
    return c.select(F.col("c8").alias("query"), none(F.col("c9")).alias("target"), F.expr("try_cast(c3 as double)").alias("pident"))


def userout(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Tab-separated hits with these columns; * means no hit. Numbers are those named pident or of lengths and counts."""
    c = spark.read.option("sep", "\t").csv(path, schema=", ".join(f"`{x}` string" for x in columns))
    kind = lambda x: "double" if x == "pident" else "int" if x in ("qlen", "tlen", "alnlen", "mism", "gaps") else "string"
    return c.select(*[F.expr(f"try_cast(nullif(`{x}`, '*') as {kind(x)})").alias(x) for x in columns])


def paf(spark: SparkSession, path: str) -> DataFrame:
    """Long-read alignments: (query, target, mapq, pident) with identity 1 - de."""
    f = F.split("value", "\t")
    raw = spark.read.text(path).where("value <> ''")
    return raw.select(f.getItem(0).alias("query"), f.getItem(5).alias("target"), f.getItem(11).cast("int").alias("mapq"), ((1 - F.expr("try_cast(nullif(regexp_extract(value, '\\\\tde:f:([0-9.eE+-]+)', 1), '') as double)")) * 100).alias("pident"))


def good_alignments(hits: DataFrame, min_mapq: int = 1, min_pident: float = 90.0) -> DataFrame:
    return hits.where((F.col("mapq") >= min_mapq) & (F.col("pident") >= min_pident))


def rdp(spark: SparkSession, path: str, cutoff: float = 0.8) -> DataFrame:
    """Fixed-rank classifier results of 20 columns: (otu, score, ranks), the leading ranks above the cutoff."""
    f = F.split("value", "\t")
    raw = spark.read.text(path).where("value <> ''").select(f.alias("f"))
    each = F.array(*[F.struct(F.concat(F.lit(f"{r}:"), F.get("f", F.lit(2 + 3 * i))).alias("r"), F.expr(f"try_cast(get(f, {4 + 3 * i}) as double)").alias("s")) for i, r in enumerate("kpcofg")])
    r = raw.select(F.get("f", F.lit(0)).alias("otu"), each.alias("e"))
    keep = F.filter("e", lambda x: x["s"] > cutoff)
    return r.select("otu", F.get(F.transform(keep, lambda x: x["s"]), F.size(keep) - 1).alias("score"), F.transform(keep, lambda x: F.replace(x["r"], F.lit('"'))).alias("ranks"))


def traits(spark: SparkSession, path: str) -> DataFrame:
    """A JSON list of trait records; of records of one taxon the last counts. A list is read in its order."""
    t = spark.read.option("multiLine", True).json(path).withColumn("_at", F.monotonically_increasing_id())
    rest = [c for c in t.columns if c not in ("taxon", "_at")]
    return t.groupBy("taxon").agg(F.max_by(F.struct(*rest), "_at").alias("r")).select("taxon", "r.*")


def classifier(spark: SparkSession, path: str, cutoff: float = 0.8) -> DataFrame:
    """Classifier results "id<tab>k:Fungi(1.0),p:..(0.93)<tab>..": (otu, score, ranks), the leading ranks that reach the
    cutoff and the score of the last of them, 0 without any."""
    f = F.split("value", "\t")
    r = spark.read.text(path).where("value <> ''").select(F.get(f, F.lit(0)).alias("otu"), F.coalesce(F.get(f, F.lit(1)), F.lit("")).alias("t"))
    r = r.withColumn("ranks", taxonomy.scored_ranks(F.col("t"), cutoff))
    return r.select("otu", F.coalesce(F.expr(r"try_cast(regexp_extract(get(split(t, ','), size(ranks) - 1), r'\(([0-9.]+)\)$', 1) as double)"), F.lit(0.0)).alias("score"), "ranks")


def blast(spark: SparkSession, path: str) -> DataFrame:
    """Hits of qseqid, sseqid, pident and stitle: (query, target, pident, title); the target is the fourth |-separated
    field of sseqid, or all of it where there are fewer."""
    f = F.split("value", "\t")
    raw = spark.read.text(path).where("value <> ''").select(f.alias("f"))
    s = F.get("f", F.lit(1))
    return raw.select(F.get("f", F.lit(0)).alias("query"), F.coalesce(F.get(F.split(s, r"\|"), F.lit(3)), s).alias("target"), F.expr("try_cast(get(f, 2) as double)").alias("pident"), F.get("f", F.lit(3)).alias("title"))


def user_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """(otu, taxonomy) of two tab-separated columns."""
    f = F.split("value", "\t", 2)
    return spark.read.text(path).where("value like '%\t%'").select(F.get(f, F.lit(0)).alias("otu"), F.get(f, F.lit(1)).alias("taxonomy"))


def sheet_by_position(spark: SparkSession, path: str) -> DataFrame:
    """A sheet of older form, columns by position: sample, barcode, forward primer, reverse primer; comment lines go, and a
    barcode that the primer contains is cut off, with what stands before it."""
    f = F.split("value", "\t")
    raw = spark.read.text(path).where("value <> '' and not startswith(value, '#')").select(f.alias("f"))
    b, p = F.get("f", F.lit(1)), F.get("f", F.lit(2))
    bare = F.when((b != "") & (F.instr(p, b) > 0), F.substring(p, F.instr(p, b) + F.length(b), F.length(p))).otherwise(p)
    return raw.select(F.get("f", F.lit(0)).alias("sample_id"), b.alias("for_barcode"), bare.alias("for_primer"), F.get("f", F.lit(3)).alias("rev_primer"))


def index_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A sheet whose barcode column holds both indexes as FORWARD-REVERSE: (sample_id, for_barcode, rev_barcode)."""
    s = sample_sheet(spark, path)
    both = F.split("for_barcode", "-")
    return s.select("sample_id", F.get(both, F.lit(0)).alias("for_barcode"), F.get(both, F.lit(1)).alias("rev_barcode"))


def names_by_sequence(records: DataFrame) -> DataFrame:
    """(seq, id) of records(id, seq); raises with examples if a sequence has several ids."""
    twice = records.groupBy("seq").agg(F.count_distinct("id").alias("n")).where("n > 1").limit(5).collect()
    if twice:
        raise ValueError(f"sequences with several names: {[r['seq'] for r in twice]}")
    return records.select("seq", "id").distinct()


def folder_names(df: DataFrame) -> DataFrame:
    """Adds sample, i5, i7, lane and mate from file names <sample>_<i5>-<i7>_L001_R1_001.fastq[.gz]."""
    name = F.element_at(F.split("source", "/"), -1)
    part = lambda p, i: F.nullif(F.regexp_extract(name, p, i), F.lit(""))
    return df.withColumns(
        {"sample": F.split(name, "_").getItem(0), "i5": part(r"_([ACGTN]+)(?:-([ACGTN]+))?_", 1), "i7": part(r"_([ACGTN]+)-([ACGTN]+)_", 2), "lane": part(r"_(L\d+)_", 1), "mate": part(r"_(R[12]|I1)[_.]", 1)}
    )


def run_folders(df: DataFrame, mapping: DataFrame | None = None) -> DataFrame:
    """Adds run and barcode from .../<run>/<barcode>/file; unclassified reads go, and with a mapping (run, barcode,
    sample) those that it does not name; without one the sample is run::barcode."""
    p = F.split("source", "/")
    d = df.withColumns({"run": F.element_at(p, -3), "barcode": F.element_at(p, -2)}).where("barcode <> 'unclassified'")
    return d.withColumn("sample", F.concat("run", F.lit("::"), "barcode")) if mapping is None else d.join(mapping, ["run", "barcode"])


def barcodes(spark: SparkSession, path: str, prefix: str = "", reverse: bool = False) -> DataFrame:
    """(pos, label, barcode): of equal names the first counts."""
    f = fasta(spark, path).withColumn("at", F.monotonically_increasing_id())
    first = f.groupBy("id").agg(F.min_by("seq", "at").alias("seq"), F.min("at").alias("at"))
    ranked = first.withColumn("pos", F.row_number().over(Window.orderBy("at")) - 1)  # a dictionary of a plate's size
    return ranked.select("pos", F.concat(F.lit(prefix), "id").alias("label"), (seq.reverse_complement(F.col("seq")) if reverse else F.col("seq")).alias("barcode"))


def bold(spark: SparkSession, path: str) -> DataFrame:
    """A barcode-of-life dump (Latin-1, tab-separated), columns by header."""
    return spark.read.option("header", True).option("sep", "\t").option("encoding", "ISO-8859-1").csv(path)


def biosample(spark: SparkSession, path: str) -> DataFrame:
    """(accession, name, project, host): Host, or Organism where that is missing."""
    b = spark.read.option("header", True).option("sep", "\t").csv(path)
    have = {c.lower(): c for c in b.columns}
    host = [F.col(f"`{have[c]}`") for c in ("host", "organism") if c in have]
    return b.select(F.col(f"`{have['accession']}`").alias("accession"), F.col(f"`{have['sample name']}`").alias("name"), F.col(f"`{have['bioproject']}`").alias("project"), F.coalesce(*host).alias("host"))


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """The table of published reference databases, by name."""
    return spark.read.parquet(path).orderBy("db_name")
