"""More registered queries of the marker-gene operators: reads, matching, scans and sinks.

Files are written to the shared folder and scanned again, so a scan and its sink are held against the table itself.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import seq
from ..functions.order import numbered
from ..functions.scratch import materialise, scratch_path, shuffles_dropped
from ..operators import demux, peaks, reads, refdb, simjoin, table, taxonomy
from ..sources import scans, sinks
from . import pipelines
from . import views as v
from .queries import plate, query, rounded

PRIMERS = ("GTGARTCATCGAATCTTTG", "TCCTCCGCTTATTGATATGC")


#: The reads with the numbers of their ids and their core between the primers.
CORES = """cores AS (
  SELECT *, CAST(string_split(read_id, '_')[2] AS BIGINT) AS o, CAST(string_split(read_id, '_')[3] AS BIGINT) AS l, CAST(string_split(read_id, '_')[4] AS BIGINT) AS p,
    CAST(string_split(read_id, '_')[5] AS BIGINT) AS s, substr(seq, 1, 8) AS bc, substr(seq, 28, length(seq) - 47) AS core FROM reads)"""


def cores(spark, sf_dir):
    ends = {"bc": F.left("seq", F.lit(8)), "core": F.substring("seq", F.lit(28), F.length("seq") - 47)}
    return v.reads(spark, sf_dir, keys=True).withColumns(ends)


def text_file(df, path: str) -> str:
    """One column of lines, written where all executors see it."""
    with shuffles_dropped(df.sparkSession):
        sinks.packed(df).text(path)
    return path


# ---- scans and sinks -------------------------------------------------------------------------------------------------


@query("SELECT sample, count(*) AS reads, CAST(sum(length(seq) + length(qual)) AS BIGINT) AS letters, md5(string_agg(md5(seq || qual), '' ORDER BY read_id)) AS digest, CAST(0 AS BIGINT) AS malformed FROM reads GROUP BY 1", v.READS)
def fastq_round_trip(spark, sf_dir):
    """Demultiplexed FASTQ written and scanned."""
    path = scratch_path(spark, "fastq")
    sinks.write_fastq(v.reads(spark, sf_dir), path)
    r = scans.fastq(spark, path).select(seq.sample_of(F.col("title")).alias("sample"), F.regexp_extract("read_id", "^R_([^;]*)", 1).alias("id"), "seq", "qual", "reason")
    each = F.transform(F.array_sort(F.collect_list(F.struct("id", F.md5(F.concat("seq", "qual")).alias("m")))), lambda x: x["m"])
    return r.groupBy("sample").agg(F.count("*").alias("reads"), F.sum(F.length("seq") + F.length("qual")).alias("letters"), F.md5(F.array_join(each, "")).alias("digest"), F.count_if(F.col("reason").isNotNull()).alias("malformed"))


@query("SELECT sample, count(*) AS reads, CAST(sum(length(seq)) AS BIGINT) AS bases FROM reads GROUP BY 1", v.READS)
def fastq_by_sample(spark, sf_dir):
    """One output a sample: the sample is the folder's name when it is scanned."""
    path = scratch_path(spark, "samples")
    sinks.write_fastq_by_sample(v.reads(spark, sf_dir), path)
    r = scans.fastq(spark, f"{path}/sample=*", numbered=False).withColumn("sample", F.regexp_extract("source", "/sample=([^/]*)/", 1))
    return r.groupBy("sample").agg(F.count("*").alias("reads"), F.sum(F.length("seq")).alias("bases"))


@query("SELECT read_id, md5(substr(seq, 1, 80) || right(seq, 60)) AS digest, md5(substr(qual, 1, 80) || right(qual, 60)) AS quality, substr(seq, 1, 8) AS code FROM reads", v.READS)
def paired_scan(spark, sf_dir):
    """R1, R2 and index files, put together by file pair and number."""
    r = v.reads(spark, sf_dir)  # the rows of a task are in the same order each time
    base, paths = scratch_path(spark, "pairs"), []
    n = F.length("seq")
    for mate, begin, size in (("R1", F.lit(1), F.lit(80)), ("R2", n - 59, F.lit(60)), ("I1", F.lit(1), F.lit(8))):
        side = r.select("read_id", F.substring("seq", begin, size).alias("seq"), F.substring("qual", begin, size).alias("qual"))
        paths.append(f"{base}/x_{mate}_001")
        sinks.write_fastq(side, paths[-1], title=F.col("read_id"))
    key = lambda c: F.regexp_replace(c, r"_(R[12]|I1)_001/part-([0-9]+)-.*$", "/$2")
    p = scans.mates(spark, *paths, key)
    there = {m: F.when(F.col(m).isNotNull(), 1).alias(m) for m in ("r1", "r2")}
    digests = F.md5(F.concat("r1.seq", "r2.seq")).alias("digest"), F.md5(F.concat("r1.qual", "r2.qual")).alias("quality")
    p = materialise(p.select("pair", "read_id", *digests, F.col("index").alias("code"), *there.values()), "mates")  # files are read once
    lost = scans.unpaired(p).select(F.col("pair").alias("read_id"), F.lit("unpaired").alias("digest"), F.lit("").alias("quality"), F.lit("").alias("code"))
    good = p.select("read_id", "digest", "quality", "code")
    return good.unionByName(lost)


@query("SELECT md5(seq) AS id, count(*) AS size, seq FROM reads GROUP BY seq", v.READS)
def fasta_round_trip(spark, sf_dir):
    """Uniques with sizes as wrapped FASTA, scanned."""
    path = scratch_path(spark, "fasta")
    sinks.write_fasta(reads.dereplicate(v.reads(spark, sf_dir)).select(F.md5("seq").alias("id"), "seq", "size"), path, size="size", width=40)
    f = scans.fasta(spark, path)
    return f.select(F.substring_index("id", ";", 1).alias("id"), seq.title_values(F.col("id"))["size"].cast("long").alias("size"), "seq")


@query("SELECT DISTINCT read_id AS id, md5(seq) AS seq, md5(qual) AS qual FROM reads", v.READS)
def fasta_with_quality(spark, sf_dir):
    """Sequences and space-separated scores in two files."""
    base, r = scratch_path(spark, "qual"), v.reads(spark, sf_dir, once=True)
    title = F.concat(F.lit(">"), "read_id", F.lit("\n"))
    text_file(r.select(F.concat(title, seq.wrap(F.col("seq"), 50))), f"{base}/fasta")
    text_file(r.select(F.concat(title, seq.score_text(F.col("qual")))), f"{base}/qual")
    return scans.fasta_with_qual(spark, f"{base}/fasta", f"{base}/qual").select("id", F.md5("seq").alias("seq"), F.md5("qual").alias("qual"))


@query(
    "SELECT 'S' || (s % 12) || CASE WHEN o % 2 = 0 THEN '' ELSE '-S' || ((s + 1) % 12) END AS sample, count(*) AS reads, CAST(sum(length(seq)) AS BIGINT) AS bases FROM cores WHERE CAST('0.9' || (o % 10) AS DOUBLE) >= 0.95 AND 60 + l * 10 >= 80 GROUP BY 1",
    v.READS, CORES,
)
def sam_scan(spark, sf_dir):
    """Circular consensus reads as SAM text: tags, barcode numbers to names, limits of both qualities."""
    c = cores(spark, sf_dir)
    tags = [F.concat(F.lit("rq:f:0.9"), F.col("o") % 10), F.concat(F.lit("zm:i:"), "o"), F.concat(F.lit("bc:B:S,"), F.col("s") % 12, F.lit(","), (F.col("s") + F.col("o") % 2) % 12), F.concat(F.lit("bq:i:"), 60 + F.col("l") * 10)]
    line = F.concat_ws("\t", "read_id", F.lit("4\t*\t0\t255\t*\t*\t0\t0"), "seq", "qual", *tags)
    s = scans.sam(spark, text_file(c.select(line), scratch_path(spark, "sam")))
    names = c.select(F.explode(F.array(F.col("s") % 12, (F.col("s") + 1) % 12)).alias("i")).distinct().select(F.col("i").cast("int").alias("pos"), F.concat(F.lit("S"), "i").alias("label"))
    good = reads.tag_quality(scans.barcode_names(s.where("reason is null"), names), 0.95, 80)
    return good.groupBy("sample").agg(F.count("*").alias("reads"), F.sum(F.length("seq")).alias("bases"))


@query(
    f"SELECT label AS sample_id, barcode AS for_barcode, CASE WHEN label < 'S5' THEN 'A{v.FORWARD}' ELSE '{v.FORWARD}' END AS for_primer, '{v.REVERSE}' AS rev_primer, reads AS \"DemuxReads\", 'T' || length(label) AS \"Treatment\" FROM barcodes JOIN (SELECT sample AS label, count(*) AS reads FROM reads GROUP BY 1) USING (label)",
    v.READS, v.BARCODES,
)
def sample_sheet_scan(spark, sf_dir):
    """A sheet whose primers hold the barcode for some samples; written with the reads of each sample."""
    b = v.barcodes(spark, sf_dir)
    primer = F.when(F.col("label") < "S5", F.concat(F.lit("CCATCTCA"), "barcode", F.lit("A" + v.FORWARD))).otherwise(v.FORWARD)
    sheet = b.select(F.col("label").alias("#SampleID"), F.col("barcode").alias("BarcodeSequence"), primer.alias("LinkerPrimerSequence"), F.lit(v.REVERSE).alias("ReversePrimer"), F.concat(F.lit("T"), F.length("label")).alias("Treatment"))
    path = scratch_path(spark, "sheet")
    sheet.write.option("header", True).option("sep", "\t").csv(path)
    s = sinks.updated_sheet(scans.sample_sheet(spark, path), reads.sample_counts(v.reads(spark, sf_dir)))
    return s.select("sample_id", "for_barcode", "for_primer", "rev_primer", "DemuxReads", "Treatment")


@query(
    f"SELECT label AS sample_id, barcode AS for_barcode, 'A{v.FORWARD}' AS for_primer, substr(barcode, 1, 4) AS f, substr(barcode, 5, 4) AS r, label AS named FROM barcodes",
    v.BARCODES,
)
def older_sheets(spark, sf_dir):
    """Columns by position, both indexes in one column, and names by sequence."""
    b, base = v.barcodes(spark, sf_dir), scratch_path(spark, "older")
    text_file(b.select(F.concat_ws("\t", "label", "barcode", F.concat(F.lit("CCATCTCA"), "barcode", F.lit("A" + v.FORWARD)), F.lit(v.REVERSE))), f"{base}/place")
    both = b.select(F.col("label").alias("#SampleID"), F.concat_ws("-", F.left("barcode", F.lit(4)), F.right("barcode", F.lit(4))).alias("BarcodeSequence"))
    both.write.option("header", True).option("sep", "\t").csv(f"{base}/index")
    index = scans.index_sheet(spark, f"{base}/index").select("sample_id", F.col("for_barcode").alias("f"), F.col("rev_barcode").alias("r"))
    names = scans.names_by_sequence(b.select(F.col("label").alias("id"), F.col("barcode").alias("seq"))).select(F.col("seq").alias("for_barcode"), F.col("id").alias("named"))
    return scans.sheet_by_position(spark, f"{base}/place").drop("rev_primer").join(index, "sample_id").join(names, "for_barcode")


@query(
    f"SELECT sample AS \"#SampleID\", coalesce(barcode, 'no_data') AS \"BarcodeSequence\", '{v.FORWARD}' AS \"LinkerPrimerSequence\", '{v.REVERSE}' AS \"ReversePrimer\", sample AS \"phinchID\", reads AS \"DemuxReads\", 'no_data' AS \"Treatment\" FROM (SELECT sample, count(*) AS reads FROM reads GROUP BY 1) LEFT JOIN (SELECT * FROM barcodes WHERE label <> 'S3') ON label = sample",
    v.READS, v.BARCODES,
)
def generic_sheet(spark, sf_dir):
    b = v.barcodes(spark, sf_dir).where("label <> 'S3'")
    return sinks.generic_sheet(reads.sample_counts(v.reads(spark, sf_dir)), b, v.FORWARD, v.REVERSE)


SUPPLIERS = "sup AS (SELECT s_suppkey AS k, 'OTU' || s_suppkey AS otu, n_name, r_name, n_nationkey AS nk FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"


def suppliers(spark, sf_dir):
    s, n, r = (v.table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    j = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return j.select(F.col("s_suppkey").alias("k"), F.concat(F.lit("OTU"), "s_suppkey").alias("otu"), "n_name", "r_name", F.col("n_nationkey").alias("nk"))


@query(
    "SELECT 'uc' AS format, otu AS query, CASE WHEN k % 3 > 0 THEN 'ref' || k END AS target, CASE WHEN k % 3 > 0 THEN 90.0 + k % 10 END AS pident FROM sup UNION ALL "
    "SELECT 'userout', otu, CASE WHEN k % 3 > 0 THEN 'ref' || k END, CASE WHEN k % 3 > 0 THEN 90.0 + k % 10 END FROM sup UNION ALL "
    "SELECT 'blast', otu, CASE WHEN k % 2 = 0 THEN 'acc' || k ELSE 'plain' || k END, 90.0 + k % 10 FROM sup UNION ALL "
    "SELECT 'paf', otu, 'ref' || k, 100 - k % 10 FROM sup WHERE k % 4 >= 1 AND k % 10 <= 5",
    SUPPLIERS,
)
def hit_scans(spark, sf_dir):
    """Hit tables of four formats; alignments by mapping quality and identity."""
    s, base = suppliers(spark, sf_dir), scratch_path(spark, "hits")
    hit, ident = F.col("k") % 3 > 0, (90 + F.col("k") % 10).cast("string")
    star = lambda c: F.when(hit, c).otherwise("*")
    ref = F.concat(F.lit("ref"), "k")
    text_file(s.select(F.concat_ws("\t", F.when(hit, "H").otherwise("N"), F.lit("0"), F.lit("64"), star(ident), F.lit("+"), F.lit("*"), F.lit("*"), F.lit("64M"), "otu", star(ref))), f"{base}/uc")
    text_file(s.select(F.concat_ws("\t", "otu", star(ref), star(ident))), f"{base}/userout")
    text_file(s.select(F.concat_ws("\t", "otu", F.when(F.col("k") % 2 == 0, F.concat(F.lit("gi|1|gb|acc"), "k", F.lit("|"))).otherwise(F.concat(F.lit("plain"), "k")), ident, F.lit("title"))), f"{base}/blast")
    text_file(s.select(F.concat_ws("\t", "otu", F.lit("64\t0\t64\t+"), ref, F.lit("64\t0\t64\t60\t64"), (F.col("k") % 4).cast("string"), F.concat(F.lit("de:f:0.0"), F.col("k") % 10))), f"{base}/paf")
    found = {
        "uc": scans.uc(spark, f"{base}/uc"),
        "userout": scans.userout(spark, f"{base}/userout", ["query", "target", "pident"]),
        "blast": scans.blast(spark, f"{base}/blast"),
        "paf": scans.good_alignments(scans.paf(spark, f"{base}/paf"), 1, 95.0 - 1e-9),
    }
    return reads.union_of(*[df.select(F.lit(name).alias("format"), "query", "target", F.round("pident", 6).alias("pident")) for name, df in found.items()])


@query(
    "SELECT otu, CAST(CASE WHEN k % 4 = 0 THEN 0.0 WHEN k % 2 = 0 THEN 1.0 WHEN k % 3 = 0 THEN 0.8 ELSE 0.95 END AS DOUBLE) AS score, CASE WHEN k % 4 = 0 THEN '' WHEN k % 2 = 0 THEN 'k:' || r_name WHEN k % 3 = 0 THEN 'k:' || r_name || ',p:' || n_name || ',c:C' ELSE 'k:' || r_name || ',p:' || n_name END AS ranks, "
    "CASE WHEN k % 5 = 0 THEN 'k:Q' ELSE 'k:Q,p:W' END AS fixed, CAST(CASE WHEN k % 5 = 0 THEN 0.9 ELSE 0.85 END AS DOUBLE) AS fixed_score, 'user ' || n_name AS by_user FROM sup",
    SUPPLIERS,
)
def classifier_scans(spark, sf_dir):
    """Classifier results with scores, fixed-rank results of 20 columns, and a user's table."""
    s, base = suppliers(spark, sf_dir), scratch_path(spark, "classified")
    k = F.col("k")
    text = F.concat(
        F.lit("k:"), "r_name", F.when(k % 4 == 0, "(0.50)").otherwise("(1.0)"), F.lit(",p:"), "n_name", F.when(k % 2 == 0, "(0.7)").otherwise("(0.95)"), F.lit(",c:C"), F.when(k % 3 == 0, "(0.8)").otherwise("(0.1)")
    )
    text_file(s.select(F.concat_ws("\t", "otu", text, F.lit("+"))), f"{base}/sintax")
    low = F.when(k % 5 == 0, "0.2").otherwise("0.85")
    text_file(s.select(F.concat_ws("\t", "otu", F.lit("-"), F.lit('"Q"\tdomain\t0.9'), F.lit("W\tphylum"), low, F.lit("\t".join(["X", "rank", "0.1"] * 4)), F.lit("x"), F.lit("y"))), f"{base}/fixed")
    text_file(s.select(F.concat_ws("\t", "otu", F.concat(F.lit("user "), "n_name"))), f"{base}/user")
    a = scans.classifier(spark, f"{base}/sintax").select("otu", "score", F.array_join("ranks", ",").alias("ranks"))
    b = scans.rdp(spark, f"{base}/fixed").select("otu", F.array_join("ranks", ",").alias("fixed"), F.col("score").alias("fixed_score"))
    c = scans.user_taxonomy(spark, f"{base}/user").select("otu", F.col("taxonomy").alias("by_user"))
    return a.join(b, "otu").join(c, "otu")


@query(
    "SELECT CASE WHEN bk % 2 = 0 THEN 'E' ELSE 'W' END || bk AS bin, 'k:Animalia,p:' || r_name || CASE WHEN m % 3 = 1 THEN '' ELSE ',c:Insecta' END AS ranks FROM (SELECT nk AS bk, r_name, arg_min(k, (CASE WHEN k % 3 = 1 THEN 1 ELSE 0 END, 'id' || lpad(CAST(k AS VARCHAR), 9, '0'))) AS m FROM sup WHERE k % 7 <> 0 AND k % 11 <> 0 GROUP BY nk, r_name)",
    SUPPLIERS,
)
def barcode_dump(spark, sf_dir):
    """A barcode-of-life dump scanned and filtered; the best taxonomy of every BIN."""
    s, path = suppliers(spark, sf_dir), scratch_path(spark, "bold")
    k, nk = F.col("k"), F.col("nk")
    dump = s.select(
        F.concat(F.lit("P"), "k").alias("processid"), F.col("r_name").alias("phylum_name"), F.when(k % 3 == 1, "Insecta 2").otherwise("Insecta").alias("class_name"), F.lit("").alias("order_name"),
        F.lit("").alias("family_name"), F.lit("").alias("genus_name"), F.lit("").alias("species_name"), F.concat(F.lit("nnAC-GT"), F.when(k % 7 == 0, "NACGT").otherwise("ACGT"), F.lit("N")).alias("nucleotides"),
        F.concat(F.lit("id"), F.lpad(k.cast("string"), 9, "0")).alias("sequenceID"), F.lit("AB1").alias("genbank_accession"),
        F.concat(F.lit("BOLD:"), F.when(nk % 2 == 0, "E").otherwise("W"), "nk").alias("bin_uri"), F.lit("A Collector").alias("identification_provided_by"), F.when(k % 11 == 0, "matK").otherwise("COI-5P").alias("marker_codes"),
    )
    dump.write.option("header", True).option("sep", "\t").option("encoding", "ISO-8859-1").option("emptyValue", "").csv(path)
    return refdb.best_by_bin(refdb.bold_records(scans.bold(spark, path))).select("bin", F.array_join("ranks", ",").alias("ranks"))


@query(
    "SELECT sample, CASE WHEN CAST(substr(sample, 2) AS BIGINT) % 3 < 2 THEN 'SAMN' || substr(sample, 2) END AS accession, CASE WHEN CAST(substr(sample, 2) AS BIGINT) % 3 < 2 THEN 'PRJ1' END AS project, "
    "CASE CAST(substr(sample, 2) AS BIGINT) % 3 WHEN 0 THEN 'Host ' || substr(sample, 2) WHEN 1 THEN 'soil' END AS host, 'MISEQ' AS platform FROM (SELECT DISTINCT sample FROM reads)",
    v.READS,
)
def submission_sheet(spark, sf_dir):
    """Samples with their repository records: by name, or by the name cut at its first - or _; Organism where there is no host."""
    samples, path = v.reads(spark, sf_dir).select("sample").distinct(), scratch_path(spark, "biosample")
    n = F.substring("sample", 2, 9).cast("long")
    b = samples.where(n % 3 < 2).select(
        F.concat(F.lit("SAMN"), n).alias("Accession"), F.when(n % 3 == 0, F.col("sample")).otherwise(F.concat("sample", F.lit("-x_y"))).alias("Sample Name"), F.lit("PRJ1").alias("BioProject"),
        F.when(n % 3 == 0, F.concat(F.lit("Host "), n)).alias("Host"), F.lit("soil").alias("Organism"),
    )
    b.write.option("header", True).option("sep", "\t").csv(path)
    return sinks.submission_sheet(samples, scans.biosample(spark, path), {"platform": "MISEQ"})


@query(
    "SELECT 's' || k AS sample, 'ACGTAC' AS i5, CASE WHEN k % 2 = 0 THEN 'TTTGGG' END AS i7, 'L001' AS lane, CASE k % 3 WHEN 0 THEN 'I1' WHEN 1 THEN 'R1' ELSE 'R2' END AS mate, CASE WHEN nk % 5 > 0 THEN 'run' || nk || '::bc' || (nk % 5) END AS by_folder FROM sup",
    SUPPLIERS,
)
def folder_scans(spark, sf_dir):
    """Samples, indexes, lane and mate from file names; runs and barcodes from folders."""
    s = suppliers(spark, sf_dir)
    k, nk = F.col("k"), F.col("nk")
    name = F.concat(F.lit("/data/x/s"), k, F.lit("_ACGTAC"), F.when(k % 2 == 0, "-TTTGGG").otherwise(""), F.lit("_L001_"), F.when(k % 3 == 0, "I1").when(k % 3 == 1, "R1").otherwise("R2"), F.lit("_001.fastq.gz"))
    files = scans.folder_names(s.select("k", name.alias("source"))).drop("source")
    runs = s.select("k", F.concat(F.lit("/data/run"), nk, F.lit("/"), F.when(nk % 5 == 0, "unclassified").otherwise(F.concat(F.lit("bc"), nk % 5)), F.lit("/f.fastq")).alias("source"))
    found = scans.run_folders(runs).select("k", F.col("sample").alias("by_folder"))
    return files.join(found, "k", "left").select("sample", "i5", "i7", "lane", "mate", "by_folder")


@query(f"SELECT 'plate' || label AS label, reverse(translate(barcode, 'ACGT', 'TGCA')) AS barcode FROM barcodes", v.BARCODES)
def barcode_dictionary(spark, sf_dir):
    """A dictionary of barcodes whose names repeat: the first counts."""
    b = v.barcodes(spark, sf_dir)
    lines = b.select("label", F.lit(0).alias("again"), "barcode").unionByName(b.select("label", F.lit(1).alias("again"), F.lit("AAAA").alias("barcode")))
    path = text_file(lines.repartition(1).sortWithinPartitions("again", "label").select(F.concat(F.lit(">"), "label", F.lit("\n"), "barcode")), scratch_path(spark, "dictionary"))
    return scans.barcodes(spark, path, "plate", reverse=True).drop("pos")


@query("SELECT 'NATION ' || n_nationkey AS taxon, 'guild' || (n_nationkey % 4) AS guild, n_name AS notes FROM nation")
def trait_list(spark, sf_dir):
    """A JSON list with two records of each taxon: the last counts."""
    n = v.table(spark, sf_dir, "nation")
    taxon, old = F.concat(F.lit("NATION "), "n_nationkey").alias("taxon"), n.select(F.lit(0).alias("turn"), F.col("n_nationkey").alias("k"), F.concat(F.lit("NATION "), "n_nationkey").alias("taxon"), F.lit("zz old").alias("guild"), F.lit("zz").alias("notes"))
    new = n.select(F.lit(1).alias("turn"), F.col("n_nationkey").alias("k"), taxon, F.concat(F.lit("guild"), F.col("n_nationkey") % 4).alias("guild"), F.col("n_name").alias("notes"))
    every = F.transform(F.array_sort(F.collect_list(F.struct("turn", "k", "taxon", "guild", "notes"))), lambda x: F.struct(x["taxon"].alias("taxon"), x["guild"].alias("guild"), x["notes"].alias("notes")))
    path = text_file(old.unionByName(new).agg(F.to_json(every).alias("value")), scratch_path(spark, "traits"))
    return scans.traits(spark, path).select("taxon", "guild", "notes")


@query("SELECT otu, sample, n, coalesce(array_to_string(ranks, ','), 'No hit') AS taxonomy FROM counts LEFT JOIN (SELECT * FROM ranks WHERE otu NOT LIKE '%7') USING (otu)", v.COUNTS, v.RANKS)
def wide_round_trip(spark, sf_dir):
    """The wide table with taxonomy written and scanned."""
    tax = v.ranks(spark, sf_dir).where("otu not like '%7'").select("otu", F.array_join("ranks", ",").alias("taxonomy"))
    path = scratch_path(spark, "wide")
    sinks.write_wide(v.counts(spark, sf_dir), path, tax)
    counts, named = table.from_wide(spark.read.option("header", True).option("sep", "\t").csv(path), "#OTU ID", "Taxonomy")
    return counts.join(named, "otu")


@query("SELECT otu, sample, n, treatment, array_to_string(coalesce(ranks, []), ',') AS ranks FROM counts JOIN metadata USING (sample) LEFT JOIN ranks USING (otu)", v.COUNTS, v.METADATA, v.RANKS)
def biom_round_trip(spark, sf_dir):
    """One BIOM document written, read as JSON, and its numbers looked up."""
    path = scratch_path(spark, "biom")
    sinks.write_biom(v.counts(spark, sf_dir), v.ranks(spark, sf_dir), v.metadata(spark, sf_dir), path)
    doc = spark.read.option("multiLine", True).json(path)
    rows = doc.select(F.posexplode("rows").alias("i", "r")).select("i", F.col("r.id").alias("otu"), F.array_join("r.metadata.taxonomy", ",").alias("ranks"))
    columns = doc.select(F.posexplode("columns").alias("j", "c")).select("j", F.col("c.id").alias("sample"), F.col("c.metadata.treatment").alias("treatment"))
    cells = doc.select(F.explode("data").alias("d")).select(F.get("d", F.lit(0)).alias("i"), F.get("d", F.lit(1)).alias("j"), F.get("d", F.lit(2)).alias("n"))
    return cells.join(rows, "i").join(columns, "j").select("otu", "sample", "n", "treatment", "ranks")


@query(
    "SELECT rank, taxon, sample, n FROM (SELECT 'p' AS rank, p AS taxon, sample, CAST(sum(n) AS BIGINT) AS n FROM j GROUP BY ALL UNION ALL SELECT 'k', k, sample, CAST(sum(n) AS BIGINT) FROM j GROUP BY ALL)",
    v.COUNTS, v.RANKS,
    "j AS (SELECT sample, n, coalesce((SELECT any_value(substr(r, 3)) FROM unnest(ranks) AS t(r) WHERE starts_with(r, 'k:')), 'Unclassified') AS k, coalesce((SELECT any_value(substr(r, 3)) FROM unnest(ranks) AS t(r) WHERE starts_with(r, 'p:')), 'Unclassified') AS p FROM counts LEFT JOIN ranks USING (otu))",
)
def rank_tables(spark, sf_dir):
    """Per-rank tables written as CSV and read back to long form."""
    path = scratch_path(spark, "ranks")
    sinks.write_rank_tables(taxonomy.summarise(v.counts(spark, sf_dir), v.ranks(spark, sf_dir), ("k", "p")), path)
    wide = spark.read.option("header", True).csv(path)
    samples = [c for c in wide.columns if c not in ("rank", "taxon")]
    long = wide.select("rank", "taxon", *[F.col(f"`{c}`").cast("long").alias(c) for c in samples]).unpivot(["rank", "taxon"], samples, "sample", "n")
    return long.where("n > 0")


@query(
    "SELECT split_part(coalesce((SELECT any_value(substr(r, 3)) FROM unnest(ranks) AS t(r) WHERE starts_with(r, 'p:')), 'Unclassified'), ' ', 1) AS taxon, sample, count(*) AS otus, CAST(sum(n) AS BIGINT) AS n FROM counts LEFT JOIN ranks USING (otu) GROUP BY 1, 2",
    v.COUNTS, v.RANKS,
)
def tables_by_taxon(spark, sf_dir):
    """A file for every taxon, read back by folder."""
    path = scratch_path(spark, "taxa")
    sinks.write_by_taxon(v.counts(spark, sf_dir), v.ranks(spark, sf_dir), "p", path)
    return spark.read.option("header", True).csv(path).groupBy("taxon", "sample").agg(F.count("*").alias("otus"), F.sum(F.col("n").cast("long")).alias("n"))


@query("SELECT otu, array_to_string(ranks, ',') AS taxonomy, CASE WHEN k % 2 = 0 THEN 'hit ' || k ELSE '' END AS alignment, CASE WHEN k % 3 = 0 THEN 'S' || k ELSE '' END AS classifier FROM ranks JOIN sup USING (otu)", v.RANKS, SUPPLIERS)
def taxonomy_evidence(spark, sf_dir):
    s, r = suppliers(spark, sf_dir), v.ranks(spark, sf_dir)
    evidence = {"alignment": s.where("k % 2 = 0").select("otu", F.concat(F.lit("hit "), "k").alias("text")), "classifier": s.where("k % 3 = 0").select("otu", F.concat(F.lit("S"), "k").alias("text"))}
    return sinks.taxonomy_table(r.select("otu", F.array_join("ranks", ",").alias("taxonomy")), evidence=evidence)


@query("SELECT r || '|' || id AS title, seq FROM (SELECT md5(seq) AS id, seq, CASE WHEN length(seq) < 105 THEN 'LENGTH' WHEN contains(seq, 'GGG') THEN 'AMBIGUOUS' END AS r FROM reads GROUP BY seq) WHERE r IS NOT NULL", v.READS)
def reject_file(spark, sf_dir):
    """Rejected records with their reasons, written and scanned."""
    u, path = reads.dereplicate(v.reads(spark, sf_dir)).select(F.md5("seq").alias("id"), "seq"), scratch_path(spark, "rejects")
    sinks.write_rejects(u.withColumn("reason", F.when(F.length("seq") < 105, "LENGTH").when(F.col("seq").contains("GGG"), "AMBIGUOUS")), path)
    return scans.fasta(spark, path).select(F.regexp_replace("id", "^ERROR:", "").alias("title"), "seq")


@query("SELECT 'its' AS db_name, count(*) AS records, 'fwd' AS forward, 'usearch' AS kind FROM supplier UNION ALL SELECT 'lsu', count(*), '', 'utax' FROM nation")
def published_databases(spark, sf_dir):
    base = scratch_path(spark, "db")
    sinks.publish(v.ranks(spark, sf_dir), f"{base}/its", f"{base}/catalogue", "its", "usearch", "1", "fwd", "rev")
    sinks.publish(v.table(spark, sf_dir, "nation"), f"{base}/lsu", f"{base}/catalogue", "lsu", "utax", "1")
    return scans.catalogue(spark, f"{base}/catalogue").select("db_name", "records", "forward", "kind")


# ---- filters and projections -----------------------------------------------------------------------------------------

EE = "list_sum(list_transform(string_split(qual, ''), lambda c: pow(10, -(ascii(c) - 33) / 10)))"


@query("SELECT count(*) AS reads, round(avg(length(seq)), 6) AS mean, min(length(seq)) AS least, max(length(seq)) AS greatest, quantile_cont(length(seq), 0.05) AS p05 FROM reads", v.READS)
def length_stats(spark, sf_dir):
    return rounded(reads.length_stats(v.reads(spark, sf_dir)), "mean")


@query("SELECT sample, count(*) AS reads FROM (SELECT sample, replace(seq, 'GATC', 'GNNC') AS seq FROM reads) WHERE NOT contains(seq, 'NN') AND length(seq) BETWEEN 105 AND 109 GROUP BY 1", v.READS)
def ambiguous_and_length(spark, sf_dir):
    r = v.reads(spark, sf_dir).withColumn("seq", F.replace("seq", F.lit("GATC"), F.lit("GNNC")))
    return reads.sample_counts(reads.by_length(reads.no_ambiguous(r, 2), 105, 109))


@query(f"SELECT sample, count(*) AS reads FROM reads WHERE length(seq) >= 106 AND -10 * log10({EE} / length(qual)) >= 22 GROUP BY 1", v.READS)
def long_reads(spark, sf_dir):
    return reads.sample_counts(reads.long_reads(v.reads(spark, sf_dir), 106, 22))


@query("SELECT sample AS source, CAST(round_even(max(length(seq)) / 10, 0) * 10 AS INTEGER) AS length FROM cores WHERE l < 3 GROUP BY 1", v.READS, CORES)
def guess_length(spark, sf_dir):
    c = cores(spark, sf_dir).withColumns({"source": F.col("sample"), "rec_no": F.col("l")})
    return reads.guess_length(c, 3)


@query("SELECT read_id, md5(seq) AS seq, md5(qual) AS qual FROM reads", v.READS)
def strip_padding(spark, sf_dir):
    r = v.reads(spark, sf_dir)
    padded, quality = seq.trim_or_pad(F.col("seq"), F.col("qual"), 130, pad=True)
    s, q = seq.strip_padding(F.col("p"), F.col("pq"))
    return r.select("read_id", padded.alias("p"), quality.alias("pq")).select("read_id", F.md5(s).alias("seq"), F.md5(q).alias("qual"))


@query("SELECT md5(seq) AS id, substr(seq, 1, 90) AS seq FROM reads GROUP BY seq HAVING count(*) < 3", v.READS)
def trim_ends(spark, sf_dir):
    u = materialise(reads.dereplicate(v.reads(spark, sf_dir)).select(F.md5("seq").alias("id"), "seq", "size"), "uniques")
    return reads.trim_three_prime(u.select("id", "seq"), 90, u.where("size >= 3"))


@query("SELECT event_type, count(*) AS pairs FROM events WHERE event_id % 3 <> 1 GROUP BY 1")
def title_index(spark, sf_dir):
    """Pairs whose titles carry the expected index, or none; numbers are no index."""
    e, i = v.table(spark, sf_dir, "events"), F.col("event_id")
    one = F.concat(F.lit("M0:"), i, F.lit(":7 1:N:0:"), F.when(i % 3 == 0, "ACGT").when(i % 3 == 1, "TTTT").otherwise("7"))
    two = F.concat(F.lit("M0:"), i, F.lit(":7 2:N:0:"), F.when(i % 2 == 0, "ACGT").otherwise("12"))
    return reads.right_index(e.select("event_type", one.alias("title1"), two.alias("title2")), "ACGT").groupBy("event_type").agg(F.count("*").alias("pairs"))


@query("SELECT p_partkey, p_name || 'AOUbe<<1/2x' AS name FROM part")
def ascii_headers(spark, sf_dir):
    p = v.table(spark, sf_dir, "part")
    return p.select("p_partkey", seq.to_ascii(F.concat("p_name", F.lit("ÄÖÜßé«½×中"))).alias("name"))


@query("SELECT o_orderkey, CASE WHEN n < 1024 THEN printf('%.1f B', n::DOUBLE) WHEN n < 1048576 THEN printf('%.1f KB', n / 1024.0) ELSE printf('%.1f MB', n / 1048576.0) END AS size FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) * (o_orderkey % 3) * 7 + 3 AS n FROM orders) WHERE n % 2 = 1")
def human_sizes(spark, sf_dir):
    o = v.table(spark, sf_dir, "orders").select("o_orderkey", (F.floor("o_totalprice") * (F.col("o_orderkey") % 3) * 7 + 3).alias("n")).where("n % 2 = 1")
    return o.select("o_orderkey", seq.human_size(F.col("n")).alias("size"))


@query("SELECT otu, row_number() OVER (ORDER BY CAST(substr(otu, 4) AS BIGINT)) AS place FROM (SELECT DISTINCT otu FROM counts)", v.COUNTS)
def natural_order(spark, sf_dir):
    o = v.counts(spark, sf_dir).select("otu").distinct().withColumn("_k", table.natural_key(F.col("otu")))
    return numbered(o, "place", F.asc("_k")).drop("_k")


@query(
    "SELECT otu, 'AC' || k || '|SH' || k || '.07FU;tax=k:Fungi,p:Asco' || CASE WHEN k % 3 = 0 THEN '' ELSE ',c:Sord' END || ',g:Pilus' || CASE WHEN k % 2 = 0 THEN ',s:Pilus albus' ELSE '' END AS unite, "
    "'AB' || k || '.1_U;tax=k:Eukaryota,p:Alveolata' || CASE WHEN k % 3 = 0 THEN '' ELSE ',c:Dino' END || ',o:MAST,g:Gym,s:Gym albus' AS pr2, "
    "'S' || k || ';tax=k:Bacteria,p:Aquificae' || CASE WHEN k % 3 = 0 THEN '' ELSE ',c:Aqui' END || ',g:Aquifex' || CASE WHEN k % 2 = 0 THEN '' ELSE ',s:Aquifex pyro' END AS rdp FROM sup",
    SUPPLIERS,
)
def reference_headers(spark, sf_dir):
    """Headers of three databases cleaned: ranks that name nothing go, and so do species of one word or of a stop word."""
    s, k = suppliers(spark, sf_dir), F.col("k")
    third = lambda a, b: F.when(k % 3 == 0, a).otherwise(b)
    u = F.concat(F.lit("Pilus_sp|AC"), k, F.lit("|SH"), k, F.lit(".07FU|reps|k__Fungi;p__Asco;c__"), third("unidentified", "Sord"), F.lit(";o__Incertae_sedis;f__X1;g__Pilus;s__Pilus_"), F.when(k % 2 == 0, "albus").otherwise("sp"))
    p = F.concat(F.lit("AB"), k, F.lit(".1_U;tax=k:Eukaryota,p:Alveolata,c:Dino"), third("_X", "_A"), F.lit(",o:MAST-4,g:Gym-A,s:Gym_albus"))
    r = F.concat(F.lit("S"), k, F.lit(" Aquifex "), F.when(k % 2 == 0, "bacterium").otherwise("pyro"), F.lit(" (T); str\tLineage=Root;rootrank;Bacteria;domain;\"Aquificae\";phylum;"), third("unclassified_Aqui", "Aqui"), F.lit(";class;Chloroplast;order;Aquifex;genus"))
    return s.select("otu", refdb.unite(u).alias("unite"), refdb.pr2(p).alias("pr2"), refdb.rdp(r).alias("rdp"))


@query("SELECT otu, array_to_string(ranks, ',') AS ranks, array_to_string(ranks[1:2], ',') AS high, coalesce((SELECT any_value(substr(r, 3)) FROM unnest(ranks) AS t(r) WHERE starts_with(r, 'p:')), 'none') AS phylum FROM ranks", v.RANKS)
def parse_taxonomy(spark, sf_dir):
    t = v.ranks(spark, sf_dir).select("otu", F.concat(F.lit("GS|99.1|AY1;"), F.array_join("ranks", ",")).alias("t"))
    r = t.select("otu", taxonomy.parse_ranks(F.col("t")).alias("r"))
    return r.select("otu", F.array_join("r", ",").alias("ranks"), F.array_join(taxonomy.truncate(F.col("r"), 2), ",").alias("high"), F.coalesce(taxonomy.rank_value(F.col("r"), "p"), F.lit("none")).alias("phylum"))


@query("SELECT reason, n, round(n / sum(n) OVER () * 100, 6) AS percent FROM (SELECT CASE WHEN length(seq) < 105 THEN 'LENGTH' WHEN contains(seq, 'GGG') THEN 'AMBIGUOUS' ELSE 'PASS' END AS reason, count(*) AS n FROM reads GROUP BY 1)", v.READS)
def reject_shares(spark, sf_dir):
    r = v.reads(spark, sf_dir).withColumn("reason", F.when(F.length("seq") < 105, "LENGTH").when(F.col("seq").contains("GGG"), "AMBIGUOUS"))
    return rounded(demux.reject_stats(r), "percent")


@query("SELECT read_id FROM reads ORDER BY md5(read_id || 'subsample'), read_id LIMIT 500", v.READS)
def subsample(spark, sf_dir):
    return reads.subsample(v.reads(spark, sf_dir), "read_id", 500).select("read_id")


@query("SELECT read_id, data FROM cores, (SELECT 'from ' || length(core) AS data, read_id AS r FROM cores WHERE o % 3 > 0 AND length(core) >= 60) WHERE r = read_id AND ((l % 4 > 0 AND o % 4 > 0 AND 50 + o % 9 >= 55) OR ((l % 4 > 0) <> (o % 4 > 0) AND length(seq) >= 55))", v.READS, CORES)
def overlap_report(spark, sf_dir):
    """Reads that an overlap report calls good and whose primers stand apart, or one of them in a long read."""
    c = cores(spark, sf_dir)
    report = c.select("read_id", F.when(F.col("o") % 3 > 0, "NotBad").otherwise("Chimeric").alias("status"), F.length("core").alias("length"), F.concat(F.lit("from "), F.length("core")).alias("data"))
    placed = c.withColumn("primers", F.array(F.when(F.col("l") % 4 > 0, 3).otherwise(-1), F.when(F.col("o") % 4 > 0, (F.lit(53) + F.col("o") % 9).cast("int")).otherwise(-1)))
    return reads.not_bad(reads.proper_reads(placed, 55, partial=True), report, 60).select("read_id", "data")


@query("SELECT sample, center, count(*) AS reads FROM (SELECT sample, length(seq) AS n FROM reads), (SELECT sample AS t, n AS center FROM peak) WHERE sample = t AND abs(n - center) <= 99 GROUP BY ALL", v.READS,
       "hist AS (SELECT sample, length(seq) AS n, count(*) AS k FROM reads GROUP BY ALL)", "peak AS (SELECT sample, n FROM hist a WHERE k >= 5 AND NOT EXISTS (SELECT 1 FROM hist b WHERE b.sample = a.sample AND abs(b.n - a.n) <= 20 AND (b.k > a.k OR (b.k = a.k AND b.n < a.n))))")
def length_peaks(spark, sf_dir):
    """Sub-clusters of the samples by peaks of their read lengths."""
    r = v.reads(spark, sf_dir).select("read_id", F.col("sample").alias("cluster"), F.length("seq").alias("length"))
    return peaks.split_by_length(r, 5, 20).groupBy(F.col("cluster").alias("sample"), "center").agg(F.count("*").alias("reads"))


# ---- matching --------------------------------------------------------------------------------------------------------

SHIFT = "translate({}, 'ACGT', 'CGTA')"


@query(
    "SELECT sample AS label, CASE WHEN o % 11 = 0 AND o % 4 > 0 THEN 'multiple_forward' WHEN o % 5 = 0 THEN 'no_reverse' END AS reason, count(*) AS reads FROM cores GROUP BY ALL",
    v.READS, CORES,
)
def demultiplex_approximate(spark, sf_dir):
    """Barcodes and primers with a base changed, forward primers that stand twice, and reads that end before the reverse primer."""
    c, o = cores(spark, sf_dir), F.col("o")
    bc = F.when(o % 3 == 0, F.concat(F.left("bc", F.lit(3)), F.translate(F.substring("bc", 4, 1), "ACGT", "CGTA"), F.substring("bc", 5, 4))).otherwise(F.col("bc"))
    first = F.when(o % 4 == 0, v.FORWARD[:9] + "G" + v.FORWARD[10:]).otherwise(v.FORWARD)
    s = F.concat(bc, first, F.when(o % 11 == 0, v.FORWARD).otherwise(""), "core", F.when(o % 5 == 0, "").otherwise(v.REVERSE))
    r = c.select("read_id", s.alias("seq")).withColumn("qual", F.repeat(F.lit("I"), F.length("seq")))
    out = demux.single_end(r, *PRIMERS, plate(spark, sf_dir), barcode_mismatches=1, primer_mismatches=2, length=100, least=40, full_length=True)
    return out.groupBy("label", "reason").agg(F.count("*").alias("reads"))


@query(
    f"SELECT f || '-' || r AS label, count(*) AS reads, CAST(sum(length(core)) AS BIGINT) AS bases FROM (SELECT core, (SELECT min(label) FROM barcodes WHERE contains(substr('ACGTTGCA', 1, CAST(o % 6 AS INTEGER)) || bc || substr('TTGAC', 1, CAST(o % 4 AS INTEGER)), barcode)) AS f, (SELECT min(label) FROM barcodes WHERE contains(substr('GATTACA', 1, CAST(o % 3 AS INTEGER)) || e, barcode)) AS r FROM (SELECT cores.*, (SELECT barcode FROM barcodes WHERE label = 'S' || ((s + 1) % 12)) AS e FROM cores)) WHERE r IS NOT NULL GROUP BY ALL",
    v.READS, CORES, v.BARCODES,
)
def floating_barcodes(spark, sf_dir):
    """Barcodes at any place before the forward primer, and others, given with trailing N, after the reverse primer."""
    codes = v.barcodes(spark, sf_dir)
    ends = codes.select(F.col("label").alias("_e"), F.col("barcode").alias("e"))
    c = cores(spark, sf_dir).join(ends, F.concat(F.lit("S"), (F.col("s") + 1) % 12) == F.col("_e"))
    part_of = lambda text, n: F.left(F.lit(text), (F.col("o") % n).cast("int"))
    s = F.concat(part_of("ACGTTGCA", 6), "bc", part_of("TTGAC", 4), F.lit(v.FORWARD), "core", F.lit(v.REVERSE), part_of("GATTACA", 3), "e")
    r = c.select("read_id", s.alias("seq")).withColumn("qual", F.repeat(F.lit("I"), F.length("seq")))
    known = plate(spark, sf_dir)
    out = demux.single_end(r, *PRIMERS, known, primer_mismatches=0, least=40, floating=True, reverse_barcodes=[(label, b + "NN") for label, b in known])
    return out.where("reason is null").groupBy("label").agg(F.count("*").alias("reads"), F.sum(F.length("seq")).alias("bases"))


@query("SELECT sample, count(*) AS reads, count_if(o % 5 = 0) AS changed FROM cores GROUP BY 1", v.READS, CORES)
def index_reads(spark, sf_dir):
    """Index reads with a base changed, matched by their distinct values, and by whole-length distance."""
    c, o = cores(spark, sf_dir), F.col("o")
    index = F.when(o % 5 == 0, F.concat(F.left("bc", F.lit(5)), F.translate(F.substring("bc", 6, 1), "ACGT", "CGTA"), F.substring("bc", 7, 2))).otherwise(F.col("bc"))
    # index reads as they come from a file: spelt once, and not again in every condition on them
    r = materialise(materialise(c.select("read_id", "o", "bc"), "cores").select("read_id", index.alias("index")), "index-reads")
    m = demux.match_index(r, plate(spark, sf_dir), 1)
    g = demux.global_barcodes(r, v.barcodes(spark, sf_dir), 1).select("index", F.col("label").alias("l2"), F.col("dist").alias("d2"))
    both = m.join(demux.few_or_shuffled(g), "index").where((F.col("barcode.label") == F.col("l2")) & (F.col("barcode.dist") == F.col("d2")))
    return both.groupBy(F.col("barcode.label").alias("sample")).agg(F.count("*").alias("reads"), F.count_if(F.col("d2") == 1).alias("changed"))


@query(
    "SELECT CASE WHEN o % 3 < 2 THEN 'X' || (s % 12) || '_' || ((s + o % 3) % 12) END AS sample_id, CASE WHEN o % 3 = 2 THEN 'no_sample' END AS reason, count(*) AS pairs, CAST(sum(length(core)) * 2 AS BIGINT) AS bases FROM cores WHERE 'S' || ((s + o % 3) % 12) IN (SELECT label FROM barcodes) GROUP BY ALL",
    v.READS, CORES, v.BARCODES,
)
def dual_barcodes(spark, sf_dir):
    """A barcode in each mate: the sheet says which combinations are samples."""
    codes = v.barcodes(spark, sf_dir)
    ends = codes.select(F.col("label").alias("_e"), F.col("barcode").alias("e"))
    c = cores(spark, sf_dir).join(ends, F.concat(F.lit("S"), (F.col("s") + F.col("o") % 3) % 12) == F.col("_e"))
    mate = lambda code: F.struct(F.concat(code, "core").alias("seq"), F.repeat(F.lit("I"), F.length("core") + 8).alias("qual"))
    n = F.substring("label", 2, 9).cast("int")
    sheet = codes.select(n.alias("a"), F.explode(F.array(n, (n + 1) % 12)).alias("b"))
    sheet = sheet.select(F.concat(F.lit("X"), "a", F.lit("_"), "b").alias("sample_id"), F.concat(F.lit("S"), "a").alias("for_label"), F.concat(F.lit("S"), "b").alias("rev_label"))
    known = plate(spark, sf_dir)
    out = demux.dual_barcodes(c.select("read_id", mate("bc").alias("r1"), mate("e").alias("r2")), sheet, known, known)
    return out.groupBy("sample_id", "reason").agg(F.count("*").alias("pairs"), F.sum(F.length("r1.seq") + F.length("r2.seq")).alias("bases"))


@query("SELECT read_id, sample, md5(core) AS seq, true AS merged FROM cores WHERE o % 7 > 0 UNION ALL SELECT read_id, sample, md5(core), true FROM cores WHERE o % 7 = 0", v.READS, CORES)
def pairs_to_reads(spark, sf_dir):
    """Mates cut from the reads and given in either order: turned round, primers cut, merged over their overlap."""
    c = cores(spark, sf_dir)
    whole = F.substring("seq", F.lit(9), F.length("seq"))
    quality = F.repeat(F.lit("I"), F.length("seq"))
    a = F.struct(F.left(whole, F.lit(75)).alias("seq"), F.left(quality, F.lit(75)).alias("qual"))
    turned = F.left(seq.reverse_complement(whole), F.lit(70))
    b = F.struct(turned.alias("seq"), F.left(quality, F.lit(70)).alias("qual"))
    swap = F.col("o") % 2 == 0
    p = c.select("read_id", "sample", F.when(swap, b).otherwise(a).alias("r1"), F.when(swap, a).otherwise(b).alias("r2"))
    p = demux.strip_pair_primers(demux.reorient_pairs(p, *PRIMERS).where("reason is null").drop("reason"), *PRIMERS)
    got = pipelines.demultiplexed(pipelines.merged_pairs(p, None, 40, False))["good"]
    return got.select("read_id", "sample", F.md5("seq").alias("seq"), "merged")


@query("SELECT read_id, CASE WHEN o % 2 = 0 THEN 'minus' ELSE 'plus' END AS orient, md5(seq) AS seq, md5(qual) AS qual FROM cores", v.READS, CORES)
def orient_reads(spark, sf_dir):
    c = cores(spark, sf_dir)
    swap = F.col("o") % 2 == 0
    r = c.select("read_id", F.when(swap, seq.reverse_complement(F.col("seq"))).otherwise(F.col("seq")).alias("seq"), F.when(swap, F.reverse("qual")).otherwise(F.col("qual")).alias("qual"))
    out = demux.orient_reads(r, *PRIMERS, internal=("GGGGGGGGGGGGGGGG", "CACACACACACACACA"))
    return out.select("read_id", "orient", F.md5("seq").alias("seq"), F.md5("qual").alias("qual"))


@query("SELECT id, CASE WHEN length(seq) < 105 THEN 'LENGTH' WHEN length(seq) - 47 < 60 THEN 'STRIPPED-LENGTH' END AS reason, md5(substr(seq, 28, length(seq) - 47)) AS seq FROM (SELECT md5(seq) AS id, seq FROM reads GROUP BY seq)", v.READS)
def strip_primers(spark, sf_dir):
    """Records of both strands cut to the region between the primers."""
    u = reads.dereplicate(v.reads(spark, sf_dir)).select(F.md5("seq").alias("id"), "seq")
    either = u.select("id", F.when(F.col("id") < "8", F.col("seq")).otherwise(seq.reverse_complement(F.col("seq"))).alias("seq"))
    out = demux.strip_primers(either, *PRIMERS, keep="for", least=60, ambiguous=8).withColumn("reason", F.when(F.length("seq").isNull(), "LENGTH").otherwise(F.col("reason")))
    whole = u.select("id", F.length("seq").alias("n"))
    return out.join(whole, "id").select("id", F.when(F.col("n") < 105, "LENGTH").otherwise(F.col("reason")).alias("reason"), F.md5("seq").alias("seq"))


# ---- similarity ------------------------------------------------------------------------------------------------------

BASES = "base AS (SELECT p_partkey AS p, substr(" + v.spell_sql("'a' || p_partkey") + " || " + v.spell_sql("'b' || p_partkey") + ", 1, 64) AS b FROM part)"
NEAR = "near AS (SELECT DISTINCT core, base.p, b, levenshtein(core, b) AS d FROM cores JOIN base USING (p))"


def bases(spark, sf_dir):
    """The 64 bases of each part, from which the reads' cores are spelt."""
    spell = lambda c: F.translate(F.md5(F.concat(F.lit(c), "p_partkey")), v.HEX, v.BASES)
    return v.table(spark, sf_dir, "part").select(F.concat(F.lit("ref"), "p_partkey").alias("id"), F.concat(spell("a"), spell("b")).alias("seq"))


def distinct_cores(spark, sf_dir):
    return cores(spark, sf_dir).select(F.col("core").alias("seq")).distinct().select(F.md5("seq").alias("id"), "seq")


@query("SELECT md5(core) AS query, 'ref' || p AS target, CAST(d AS INTEGER) AS dist, round(100 * (1 - d / 64), 6) AS pident FROM near WHERE d <= 6", v.READS, CORES, BASES, NEAR)
def best_hits(spark, sf_dir):
    """Distinct cores in the parts' bases at 90 %."""
    return rounded(simjoin.best_hit(distinct_cores(spark, sf_dir), bases(spark, sf_dir), 0.9, 8), "pident")


@query("SELECT md5(core) AS query, 'ref' || p AS target, CASE WHEN md5(core) < '8' THEN '+' ELSE '-' END AS strand, CAST(d AS INTEGER) AS dist FROM near WHERE d <= 16", v.READS, CORES, BASES, NEAR)
def top_hits(spark, sf_dir):
    """All hits tied at the best identity, either strand, at 75 %."""
    q = distinct_cores(spark, sf_dir)
    q = q.select("id", F.when(F.col("id") < "8", F.col("seq")).otherwise(seq.reverse_complement(F.col("seq"))).alias("seq"))
    return simjoin.top_hits(q, bases(spark, sf_dir), 0.75, 8).where("target is not null").select("query", "target", "strand", "dist")


@query("SELECT 'ref' || p AS otu, sample, count(*) AS n FROM cores JOIN near USING (core, p) WHERE d <= 3 GROUP BY ALL", v.READS, CORES, BASES, NEAR)
def map_reads(spark, sf_dir):
    """Reads counted by the part whose bases they have, at 95 %."""
    r = cores(spark, sf_dir).select("sample", F.col("core").alias("seq"))
    return table.count_table(simjoin.map_reads(r, bases(spark, sf_dir), 0.95))


@query("SELECT sample, count(*) AS reads FROM cores JOIN near USING (core, p) WHERE NOT (p % 3 = 0 AND d <= 3) GROUP BY 1", v.READS, CORES, BASES, NEAR)
def without_contaminants(spark, sf_dir):
    bad = bases(spark, sf_dir).where(F.substring("id", 4, 9).cast("long") % 3 == 0)
    return reads.sample_counts(simjoin.without_contaminants(cores(spark, sf_dir).select("sample", F.col("core").alias("seq")), bad, 0.95))


@query("SELECT 'rc' || p AS id FROM base WHERE p % 2 = 0", BASES)
def wrong_strand(spark, sf_dir):
    """Records that are the other strand of a more abundant one."""
    b = bases(spark, sf_dir)
    n = F.substring("id", 4, 9).cast("long")
    turned = b.where(n % 4 < 3).select(F.concat(F.lit("rc"), n).alias("id"), seq.reverse_complement(F.col("seq")).alias("seq"), n.alias("n"))
    other = b.where(n % 4 == 3).select(F.concat(F.lit("xx"), n).alias("id"), F.reverse("seq").alias("seq"), n.alias("n"))
    every = b.select("id", "seq", n.alias("n")).unionByName(turned.where("n % 2 = 0")).unionByName(other)
    sizes = every.select("id", F.when(F.col("id").startswith("ref"), 10).otherwise(5).alias("size"))
    return simjoin.wrong_strand(every.select("id", "seq"), sizes)


@query(
    "SELECT 'ref' || p AS otu, 'm' || m AS mock, round(100 * (1 - d / 64), 6) AS pident, 64 AS length, CAST(d AS INTEGER) AS diffs FROM (SELECT p, m, levenshtein(b, mb) AS d FROM base, mock) WHERE d <= 22",
    BASES,
    "mock AS (SELECT p AS m, CASE WHEN p % 2 = 0 THEN substr(b, 1, 30) || translate(substr(b, 31, 2), 'ACGT', 'CATG') || substr(b, 33, 32) ELSE b END AS mb FROM base WHERE p <= 20)",
)
def mock_community(spark, sf_dir):
    """A mock community's members found among all records, at 65 %: also records that are as near by chance."""
    b, n = bases(spark, sf_dir), F.substring("id", 4, 9).cast("long")
    changed = F.when(n % 2 == 0, F.concat(F.left("seq", F.lit(30)), F.translate(F.substring("seq", 31, 2), "ACGT", "CATG"), F.substring("seq", 33, 32))).otherwise(F.col("seq"))
    mock = b.where(n <= 20).select(F.concat(F.lit("m"), n).alias("id"), changed.alias("seq"))
    return rounded(simjoin.mock_hits(b, mock), "pident")


@query(
    "SELECT CASE WHEN o % 2 = 0 THEN 'lca' ELSE 'first' END AS how, seq, 'ref' || r AS ref, CASE WHEN o % 2 > 0 OR n = 1 THEN 'k:Q,p:A' || CAST(r AS BIGINT) % 2 ELSE 'k:Q' || CASE WHEN m = 1 THEN ',p:A' || CAST(r AS BIGINT) % 2 ELSE '' END END AS ranks FROM (SELECT CAST(0 AS BIGINT) AS o, core AS seq, min(CAST(p AS VARCHAR)) AS r, count(*) AS n, count(DISTINCT p % 2) AS m FROM one GROUP BY core UNION ALL SELECT 1, core, min(CAST(p AS VARCHAR)), count(*), 1 FROM one GROUP BY core)",
    v.READS, CORES, "one AS (SELECT DISTINCT substr(core, 1, 4) AS core, 100000 + p AS p FROM cores)",
)
def dereplicate_references(spark, sf_dir):
    """Identical records once: with the first record's ranks, and with those that all of them have."""
    c = cores(spark, sf_dir).select(F.left("core", F.lit(4)).alias("seq"), (F.col("p") + 100000).alias("p")).distinct()
    c = materialise(c, "references")  # reads are spelt once for both
    s = c.select("seq", F.concat(F.lit("ref"), "p").alias("ref"), F.array(F.lit("k:Q"), F.concat(F.lit("p:A"), F.col("p") % 2)).alias("ranks"))
    parts = [refdb.dereplicate(s, lca=lca).select(F.lit(name).alias("how"), "seq", "ref", F.array_join("ranks", ",").alias("ranks")) for name, lca in (("lca", True), ("first", False))]
    return parts[0].unionByName(parts[1])
