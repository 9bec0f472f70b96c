"""Reference databases: header cleaning, quality control, dereplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import cluster, simjoin

#: What marks a rank or a species name as no name.
NO_RANK = ["unidentified", "Incertae", "uncultured", "Group", "incertae"]
NO_SPECIES = [" sp", "_sp", "uncultured", "isolate", "mycorrhizae", "vouchered", "fungal", "basidiomycete", "ascomycete", "fungus", "symbiont"]
NO_RDP_RANK = ["unidentified", "Incertae", "uncultured", "Group", "incertae", "Chloroplast", "unclassified", "Family", "leaf"]
NO_RDP_SPECIES = [" sp", "_sp", "uncultured", "isolate", "mycorrhizae", "vouchered", "fungal", "basidiomycete", "ascomycete", "fungus", "symbiont", "unclassified", "unidentified", "bacterium", "phytoplasma", "genogroup"]
NO_PR2 = ["_clade", "_Clade", "-lineage", "_cluster", "_Group", "_sp1-", "-Group", "MAST-", "-Clade", "BurkholderiaCaballeroniaParaburkholderia"]


def holds_any(text: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | text.contains(w)
    return out


def unite(header: Column) -> Column:
    """Genus_sp|accession|SH|reps|k__..;p__.. to accession|SH;tax=k:..,p:..; null without accession or taxonomy.

    Ranks with numbers or that name nothing are left out; a species needs two words.
    """
    f = F.split(header, r"\|")
    first = lambda test: F.get(F.filter(f, test), F.lit(0))
    tax = first(lambda x: F.startswith(x, F.lit("k__")))
    sh = first(lambda x: F.startswith(x, F.lit("SH")))
    other = lambda x: ~F.startswith(x, F.lit("k__")) & ~F.startswith(x, F.lit("SH")) & ~F.startswith(x, F.lit("re")) & ~x.contains("_")
    plain = F.filter(f, other)
    acc = F.get(plain, F.size(plain) - 1)
    levels = F.transform(F.split(tax, ";"), lambda x: F.replace(F.replace(x, F.lit("__"), F.lit(":")), F.lit("_"), F.lit(" ")))
    high = F.filter(F.slice(levels, 1, 6), lambda x: ~holds_any(x, NO_RANK) & ~x.rlike("[0-9]") & (F.length(x) > 2))
    s = F.replace(F.regexp_replace(F.coalesce(F.get(levels, F.lit(6)), F.lit("s:")), r"\(.*$", ""), F.lit("."))
    low = F.when((F.size(F.split(s, " ")) >= 2) & ~holds_any(s, NO_SPECIES), F.array(s)).otherwise(F.array().cast("array<string>"))
    return F.when(acc.isNotNull() & tax.isNotNull(), F.concat(acc, F.lit("|"), F.coalesce(sh, F.lit("NA")), F.lit(";tax="), F.array_join(F.concat(high, low), ",")))


def pr2(header: Column) -> Column:
    """id;tax=k:..: organelle marks joined by -, clades and numbered names left out, genus and above cut at _ and -."""
    ident, tax = F.substring_index(header, ";tax=", 1), F.regexp_extract(header, ";tax=(.*)$", 1)
    tax = F.regexp_replace(tax, ":(mito|apic|plas)", "-$1")

    def clean(x: Column) -> Column:
        high = x.rlike("^[kpcofg]:")
        cut = F.substring_index(x, "_", 1)
        cut = F.when(~cut.rlike("-apic|-mito|plas"), F.substring_index(cut, "-", 1)).otherwise(cut)
        return F.when(high, cut).when(x.rlike("^s:"), F.replace(x, F.lit("_"), F.lit(" "))).otherwise(x)

    kept = F.filter(F.split(tax, ","), lambda x: ~x.contains("_X") & ~(x.rlike("^s:") & x.rlike("(_sp\\.|_spB)$")))
    levels = F.filter(F.transform(kept, clean), lambda x: ~holds_any(x, NO_PR2) & ~x.rlike("[0-9]"))
    return F.concat(ident, F.lit(";tax="), F.array_join(levels, ","))


def rdp(header: Column) -> Column:
    """"id Species;..<tab>..;name;rank;.." to id;tax=k:..: a rank's name stands before its word."""
    left, lineage = F.substring_index(header, "\t", 1), F.element_at(F.split(header, "\t"), -1)
    name = F.substring_index(left, ";", 1)
    parts = F.split(lineage, ";")

    def rank(word: str, letter: str) -> Column:
        at = F.array_position(parts, word)
        value = F.substring_index(F.replace(F.get(parts, (at - 2).cast("int")), F.lit('"')), " ", 1)
        return F.when((at > 1) & ~holds_any(value, NO_RDP_RANK) & ~value.rlike("[0-9]"), F.concat(F.lit(f"{letter}:"), value))

    s = F.replace(F.replace(F.regexp_replace(F.regexp_extract(name, r"^\S+ (.*)$", 1), r"\(.*$", ""), F.lit(","), F.lit("_")), F.lit("."))
    words = F.filter(F.split(F.trim(s), " "), lambda w: ~w.isin("cf", "aff") & ~w.rlike("^[IVX]+$"))
    species = F.when((F.size(words) >= 2) & ~holds_any(s, NO_RDP_SPECIES) & ~s.rlike("[0-9]"), F.concat(F.lit("s:"), F.array_join(words, " ")))
    ranks = [rank(w, c) for w, c in zip(("domain", "phylum", "class", "order", "family", "genus"), "kpcofg")]
    return F.concat(F.substring_index(name, " ", 1), F.lit(";tax="), F.array_join(F.array_compact(F.array(*ranks, species)), ","))


def header_reason(seqs: DataFrame) -> DataFrame:
    """Adds reason NO_ID or NO_TAX to records whose cleaned ``header`` is missing or without ranks."""
    h = F.col("header")
    return seqs.withColumn("reason", F.when(h.isNull() | (h == ""), "NO_ID").when(F.endswith(F.trim(h), F.lit("tax=")), "NO_TAX"))


def dereplicate(seqs: DataFrame, lca: bool = False) -> DataFrame:
    """(seq, ref, ranks) of seqs(ref, ranks, seq): identical sequences once, with the most ranks (the smallest ref of those).

    With ``lca`` ranks on which those disagree are cut from the first disagreement on; a rank is kept if as many records
    have it in its place as there are, so no group is gathered.
    """
    s = seqs.withColumn("k", F.size("ranks"))
    most = s.groupBy("seq").agg(F.max("k").alias("k"))
    s = s.join(most, ["seq", "k"])
    first = s.groupBy("seq").agg(F.min_by(F.struct("ref", "ranks"), "ref").alias("f"), F.count("*").alias("c"))
    if not lca:
        return first.select("seq", "f.ref", "f.ranks")
    place = s.select("seq", F.posexplode("ranks").alias("i", "r")).groupBy("seq", "i", "r").agg(F.count("*").alias("n"))
    agree = first.select("seq", "c", F.posexplode("f.ranks").alias("i", "r")).join(place, ["seq", "i", "r"], "left")
    stop = agree.groupBy("seq").agg(F.min(F.when(F.coalesce("n", F.lit(0)) < F.col("c"), F.col("i"))).alias("stop"))
    out = first.join(stop, "seq", "left")
    return out.select("seq", "f.ref", F.when(F.col("stop").isNotNull(), F.slice("f.ranks", F.lit(1), F.col("stop"))).otherwise(F.col("f.ranks")).alias("ranks"))


def bold_records(dump: DataFrame, marker: str = "COI", need_accession: bool = False) -> DataFrame:
    """(bin, id, ranks, seq) of a barcode-of-life dump: right marker, a BIN, and sequences without inner N.

    Species that repeat a word of the identifier's name, and names with numbers, are no names; gaps and outer N go.
    """
    s = F.btrim(F.replace(F.upper("nucleotides"), F.lit("-")), F.lit("N"))
    acc = F.coalesce("genbank_accession", F.lit(""))
    good = F.col("markercode" if "markercode" in dump.columns else "marker_codes").contains(marker) & (F.coalesce("bin_uri", F.lit("")) != "") & (s != "") & ~s.contains("N")
    if need_accession:
        good = good & (acc != "") & ~acc.contains("Pending") & ~acc.contains("SUPPRESSED")
    by = F.filter(F.split(F.coalesce("identification_provided_by", F.lit("")), " "), lambda w: F.length(w) > 2)

    def rank(letter: str, column: str) -> Column:
        name = F.trim(F.coalesce(column, F.lit("")))
        bad = (name == "") | name.rlike("[0-9]") | F.exists(by, lambda w: F.contains(name, w))
        return F.when(~bad, F.concat(F.lit(f"{letter}:"), name))

    ranks = F.array_compact(F.array(F.lit("k:Animalia"), *[rank(c, f"{n}_name") for c, n in zip("pcofgs", ("phylum", "class", "order", "family", "genus", "species"))]))
    return dump.where(good).select(F.regexp_replace("bin_uri", "^BOLD:", "").alias("bin"), F.col("sequenceID").alias("id"), ranks.alias("ranks"), s.alias("seq"))


def best_by_bin(records: DataFrame) -> DataFrame:
    """(bin, ranks): the most ranks of each BIN, ties to the smallest id."""
    return records.groupBy("bin").agg(F.min_by("ranks", F.struct((-F.size("ranks")).alias("k"), "id")).alias("ranks"))


def representatives(records: DataFrame, identity: float = 0.97, k: int | None = 12) -> DataFrame:
    """(bin, id, seq): the centroids of each BIN's own clusters of records(bin, id, seq); equal sequences count as one
    that is as abundant. The centroid stands for its cluster, and not a consensus of columns."""
    uniques = records.groupBy("bin", "seq").agg(F.min("id").alias("id"), F.count("*").alias("size"))
    bins = uniques.select("id", "bin")
    hits = simjoin.similar(uniques.select("id", "seq"), uniques.select("id", "seq"), identity, k).where("query <> target")
    same = hits.join(bins.withColumnsRenamed({"id": "query", "bin": "_b1"}), "query").join(bins.withColumnsRenamed({"id": "target", "bin": "_b2"}), "target")
    same = same.where("_b1 = _b2").drop("_b1", "_b2")
    found = cluster.cluster(uniques.select("id", "seq", "size"), identity, pairs=same).select(F.col("centroid").alias("id")).distinct()
    return uniques.join(found, "id", "left_semi").select("bin", "id", "seq")


def name_representatives(reps: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """(id, header, seq): representatives(bin, id, seq) under their BIN's taxonomy(bin, ranks), as id|bin;tax=k:..,p:..;
    one of every id, the longest."""
    named = reps.join(taxonomy, "bin")
    one = named.groupBy("id").agg(F.max_by(F.struct("bin", "ranks", "seq"), F.struct(F.length("seq"), "seq", "bin")).alias("o"))
    return one.select("id", F.concat("id", F.lit("|"), "o.bin", F.lit(";tax="), F.array_join("o.ranks", ",")).alias("header"), F.col("o.seq").alias("seq"))


def barcode_reference(dump: DataFrame, marker: str = "COI", need_accession: bool = False, identity: float = 0.97) -> DataFrame:
    """A barcode-of-life dump to reference records (id, header, seq)."""
    records = bold_records(dump, marker, need_accession)
    return name_representatives(representatives(records.select("bin", "id", "seq"), identity), best_by_bin(records))
