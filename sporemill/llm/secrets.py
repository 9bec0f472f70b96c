"""Secret scanning: candidates by form, then a random forest that removes false positives (DataFrame functions only).

A candidate is a token of at least ``LEAST`` characters that has a digit or unlikely letter transitions; and, whatever
its digits and length, one of a known key format, one that a credential's name precedes or is assigned, and one in the
body of a PEM private key. Its features are length, shares of character classes, transitions between classes, the mean log
probability of its letter transitions under the words of the whole corpus, how much of it dictionary words cover (words
that occur ``DICTIONARY`` times or more in the corpus), path and address marks, and its neighbouring words (their hashes).
The forest is fitted on labelled findings, a bounded sample. The marks that the default labels go by (known formats, the
names of credentials, assignment) are no features, so the forest learns what secrets look like and not the rule.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, materialise

LEAST = 10
MASK = "[SECRET]"
DICTIONARY = 5
#: Labelled findings that the forest is fitted on, at most; chosen by a hash.
SAMPLE = 20_000
TREES, DEPTH = 30, 6
#: Parts of the values, each scored by a forest of the others; and labels of a kind that a forest needs at least.
FOLDS, FEWEST = 4, 5
NEIGHBOUR_BINS = 8
SALTS = 16
SPLIT = r"""[\x00-\x20"'`<>(),;\[\]{}]+"""
ASSIGNED = r"^([A-Za-z][A-Za-z0-9_.-]*[=:]+)"
EDGES = r"^[.,:!?&%#*$|-]+|[.,:!?&%#*$|-]+$"
CREDENTIAL = r"(?i)(token|passphrase|passw|passwd|pwd|secret|api_?key|apikey|access_?key|auth|bearer|credential|private_?key)"
#: Key formats that are secrets by themselves.
KNOWN = r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}|^sk-[A-Za-z0-9]{20,}"
#: What stands in manuals and examples where a secret would.
PLACEHOLDER = r"(?i)(example|sample|placeholder|change.?me|dummy|redacted|insert|x{4,}|0{6,}|1234567|\*{3,})|^(your|my|some|the)[_-]|[_-](here|goes|name)\b"
PASSWORD = r"(?i)(passphrase|passw|passwd|pwd|secret)[A-Za-z0-9_.-]*[=:]*$"
SIGN = r"^(=|:|:=|=>|->)$"
#: Where a text is cut so that the body of a private key is a piece of its own; the piece before it ends as PEM_HEAD says.
PEM_CUT = r"(?<=PRIVATE KEY-----)(?=\s)|(?<=\s)(?=-----END )"
PEM_HEAD = r"-----BEGIN [A-Z ]*PRIVATE KEY-----$"
PEM_BODY = r"^[A-Za-z0-9+/=]{4,}$"
PEM_KEY = "private_key:"
#: Mean log probability of a letter after another where letters are drawn evenly; words of a language are likelier.
EVEN = -math.log(27)
UNSEEN = -8.0


def fluency_of(value: Column, logp: list[float]) -> Column:
    """Mean log probability of the transitions between the letters a-z of ``value``; null without any."""
    table = F.array(*[F.lit(x) for x in logp])
    # a fold over the characters, so that ``value`` is computed once and not for every letter
    start = F.struct(F.lit(0).alias("c"), F.lit(0.0).alias("sum"), F.lit(0).alias("n"))

    def step(acc: Column, x: Column) -> Column:
        c = F.ascii(x) - 96
        c = F.when((c >= 1) & (c <= 26), c).otherwise(0)
        both = (acc["c"] > 0) & (c > 0)
        return F.struct(c.alias("c"), (acc["sum"] + F.when(both, F.get(table, acc["c"] * 27 + c)).otherwise(0.0)).alias("sum"), (acc["n"] + F.when(both, 1).otherwise(0)).alias("n"))

    return F.aggregate(F.split(F.lower(value), ""), start, step, lambda acc: F.when(acc["n"] > 0, acc["sum"] / acc["n"]))


def in_private_key(whole: Column) -> Column:
    """For each token of ``split(whole, SPLIT)``, whether it is in the body of a private key; empty for texts without one.

    The text is cut before and after bodies; a cut makes one empty token at the side where the blank is."""
    pieces = F.split(whole, PEM_CUT)

    def flags(piece: Column, i: Column) -> Column:
        blank = F.when((i > 0) & piece.rlike(r"^\s"), 1).otherwise(0) + F.when((i < F.size(pieces) - 1) & piece.rlike(r"\s$"), 1).otherwise(0)
        return F.array_repeat(F.coalesce(F.get(pieces, i - 1).rlike(PEM_HEAD), F.lit(False)), F.size(F.split(piece, SPLIT)) - blank)

    return F.when(whole.contains("PRIVATE KEY-----"), F.flatten(F.transform(pieces, flags))).otherwise(F.array().cast("array<boolean>"))


def findings(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", logp: list[float] | None = None) -> DataFrame:
    """Candidates: (doc_id, row, pos, value, key, before, before2, after); row, a hash of the text, tells repeated ids apart.

    ``logp`` are the log probabilities of ``letter_table``; without them no token is a candidate for its transitions. Null
    and empty texts have no candidates, an empty table none; rows repeated under one id give their candidates each.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    d = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("row"), F.split(whole, SPLIT).alias("w"), in_private_key(whole).alias("pem"), whole.rlike(CREDENTIAL).alias("speaks"))
    # neighbours are shifted arrays, not looked up in the whole text, which would be copied to every token
    none = F.array(F.lit(""))
    d = d.select("doc_id", "row", "speaks", F.col("w").alias("t"), F.concat(none, "w").alias("before"), F.concat(none, none, "w").alias("before2"), F.slice(F.concat("w", none), 2, F.size("w")).alias("after"), "pem")
    each = d.select("doc_id", "row", "speaks", F.posexplode(F.arrays_zip("t", "before", "before2", "after", "pem")).alias("pos", "z")).where("z.t <> ''")
    each = each.select("doc_id", "row", "speaks", "pos", "z.t", "z.before", "z.before2", "z.after", (F.coalesce("z.pem", F.lit(False)) & F.col("z.t").rlike(PEM_BODY)).alias("pem"))
    bare = F.regexp_replace(F.regexp_replace("t", ASSIGNED, ""), EDGES, "")
    key = F.when(F.col("pem"), PEM_KEY).otherwise(F.regexp_extract("t", ASSIGNED, 1))
    # cheap conditions first: only what may be a candidate is cut
    beside = F.col("before").rlike(CREDENTIAL) | (F.col("before").rlike(SIGN) & F.col("before2").rlike(CREDENTIAL))
    named = F.col("speaks") & (F.col("t").rlike(CREDENTIAL) | beside)
    each = each.where(F.col("pem") | (F.length("t") >= LEAST) | named)
    each = each.select("doc_id", "row", "speaks", "pos", bare.alias("value"), key.alias("key"), "before", "before2", "after").where(F.col("value").rlike(r"[\p{L}\p{N}]") & (F.col("value") != MASK.strip("[]")))
    v = F.col("value")
    follows = (F.col("key") == PEM_KEY) | (F.col("speaks") & (F.col("key").rlike(CREDENTIAL) | beside))
    odd = F.lit(False) if logp is None else F.coalesce(fluency_of(v, logp) < EVEN, F.lit(False))
    long = F.length("value") >= LEAST
    return each.where((long & v.rlike("[0-9]")) | v.rlike(KNOWN) | follows | (long & ~v.rlike("[0-9]") & odd)).drop("speaks")


def dictionary(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): lower-case words of three letters or more that occur DICTIONARY times or more."""
    w = docs.select(F.explode(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[\x00-\x60\x7B-\x7F]+")).alias("word")).where(F.length("word") >= 3)
    return w.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= DICTIONARY)


def letter(c: Column) -> Column:
    """A lower-case a-z as itself, any other character as #."""
    return F.when(c.rlike("^[a-z]$"), c).otherwise("#")


def pairs(word: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(word) - 1), lambda i: F.concat(letter(F.substring(word, i, F.lit(1))), letter(F.substring(word, i + 1, F.lit(1)))))


def transitions(words: DataFrame) -> DataFrame:
    """(pair, logp): log probability of the second character after the first; 27 * 27 rows at most."""
    n = words.select("n", F.explode(pairs(F.col("word"))).alias("pair")).groupBy("pair").agg(F.sum("n").alias("n"))
    first = n.groupBy(F.substring("pair", 1, 1).alias("first")).agg(F.sum("n").alias("total"))
    n = n.join(F.broadcast(first), F.substring("pair", 1, 1) == F.col("first"))
    return n.select("pair", F.log((F.col("n") + 1) / (F.col("total") + 27)).alias("logp"))


def letter_table(words: DataFrame) -> list[float]:
    """The log probability of letter j after letter i (a = 1) at i * 27 + j; the pairs come to the driver, 27 * 27 at most."""
    number = lambda c: ord(c) - 96 if c != "#" else 0
    table = [UNSEEN] * 729
    for r in transitions(words).collect():
        table[number(r["pair"][0]) * 27 + number(r["pair"][1])] = r["logp"]
    return table


def mean_transition(value: Column, logp: list[float]) -> Column:
    """Mean log probability of all transitions of ``value``, other characters than a-z being one; UNSEEN without any."""
    table = F.array(*[F.lit(x) for x in logp])
    start = F.struct(F.lit(-1).alias("c"), F.lit(0.0).alias("sum"), F.lit(0).alias("n"))

    def step(acc: Column, x: Column) -> Column:
        c = F.ascii(x) - 96
        c = F.when((c >= 1) & (c <= 26), c).otherwise(0)
        go = acc["c"] >= 0
        return F.struct(c.alias("c"), (acc["sum"] + F.when(go, F.get(table, acc["c"] * 27 + c)).otherwise(0.0)).alias("sum"), (acc["n"] + F.when(go, 1).otherwise(0)).alias("n"))

    return F.aggregate(F.split(F.lower(value), ""), start, step, lambda acc: F.when(acc["n"] > 0, acc["sum"] / acc["n"]).otherwise(UNSEEN))


ID = ["doc_id", "row", "pos"]
FEATURES = ["len", "digits", "uppers", "lowers", "others", "distinct", "changes", "fluency", "coverage", "slashes", "at_sign", "dots", "scheme"] + [
    f"{side}{i}" for side in ("b", "a", "k") for i in range(NEIGHBOUR_BINS)
]


def describe(found: DataFrame, words: DataFrame, logp: list[float] | None = None) -> DataFrame:
    """Adds FEATURES to candidates; ``logp`` as by ``letter_table``."""
    v = F.col("value")
    logp = letter_table(words) if logp is None else logp
    salt = F.pmod(F.xxhash64("doc_id", "pos"), F.lit(SALTS).cast("long"))
    pieces = found.select(*ID, salt.alias("salt"), F.explode(F.expr("regexp_extract_all(lower(value), '[a-z]{3,}', 0)")).alias("word"))
    known = words.select("word").join(pieces.select("word").distinct(), "word", "left_semi").select("word", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")).alias("salt"))
    covered = pieces.join(known, ["word", "salt"]).groupBy(*ID).agg(F.sum(F.length("word")).alias("covered"))

    share = lambda chars: F.length(F.regexp_replace("value", f"[^{chars}]", "")) / F.length("value")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace("value", "[A-Z]+", "\u0001"), r"[^\x010-9]+", "\u0002"), "[0-9]+", "\u0003")
    flag = lambda c: c.cast("double")
    hashed = lambda side, c: [flag(F.pmod(F.xxhash64(F.lower(c)), F.lit(NEIGHBOUR_BINS)) == i).alias(f"{side}{i}") for i in range(NEIGHBOUR_BINS)]
    plain = found.select(
        *ID, "value", "key", "before", "before2", "after",
        F.length("value").cast("double").alias("len"), share("0-9").alias("digits"), share("A-Z").alias("uppers"), share("a-z").alias("lowers"), (1 - share("A-Za-z0-9")).alias("others"),
        (F.size(F.array_distinct(F.split("value", ""))) / F.length("value")).alias("distinct"),
        (F.length(classes) / F.length("value")).alias("changes"),
        (F.length(F.regexp_replace("value", "[^/]", "")) / F.lit(1.0)).alias("slashes"),
        flag(v.contains("@")).alias("at_sign"),
        F.length(F.regexp_replace("value", "[^.]", "")).cast("double").alias("dots"),
        flag(v.contains("://")).alias("scheme"),
        *hashed("b", F.concat_ws(" ", "before2", "before")), *hashed("a", F.col("after")), *hashed("k", F.col("key")),
        mean_transition(v, logp).alias("fluency"),
    )
    covered = covered.select(*[F.col(c).alias(f"_{c}") for c in ID], "covered")
    out = plain.join(covered, (F.col("doc_id").eqNullSafe(F.col("_doc_id"))) & (F.col("row") == F.col("_row")) & (F.col("pos") == F.col("_pos")), "left").drop(*[f"_{c}" for c in ID])
    return out.withColumn("coverage", F.coalesce("covered", F.lit(0)) / F.length("value")).drop("covered")


def rule_labels(found: DataFrame) -> DataFrame:
    """Labels by rule for corpora that come without labelled findings: 1, 0, or null where no rule speaks.

    1: a known key format, a mixed value that a credential's name is assigned, or a value of four characters or more that a
    password's name is assigned, in one token or, unless it is a plain word, in several. 0: addresses, numbers, dates, links,
    placeholders, words joined to identifiers, and plain words that nothing is assigned.
    """
    v, named = F.col("value"), F.concat_ws(" ", "key", "before", "before2")
    mixed = v.rlike(r"^[A-Za-z0-9+/_=-]{12,}$") & v.rlike("[A-Za-z]") & (v.rlike("[0-9]") | (F.col("fluency") < EVEN))
    assigned = (F.length("key") > 0) | F.col("before").isin("=", ":", ":=")
    good = v.rlike(KNOWN) | (mixed & assigned & named.rlike(CREDENTIAL))
    bad = v.rlike(r"^[^@]+@[^@]+\.[A-Za-z.]+$|^[0-9.,:/+_-]+$|^[a-z]+://|^www\.")
    bad = bad | v.rlike(PLACEHOLDER) | v.rlike("^[a-z]{2,}([_-][a-z]{2,})+$")
    bad = bad | (~assigned & v.rlike("^[A-Za-z]+$") & ((F.length("value") < 4) | ((F.col("coverage") >= 1) & (F.col("fluency") >= EVEN))))
    word = v.rlike("^[A-Za-z]+$") & (F.col("coverage") >= 1)
    spaced = F.when(F.col("before").rlike(SIGN), F.col("before2")).when(F.col("before").rlike("[=:]$"), F.col("before"))
    password = (F.length("value") >= 4) & (F.col("key").rlike(PASSWORD) | (~word & F.coalesce(spaced.rlike(PASSWORD), F.lit(False))))
    return found.withColumn("label", F.when((good & ~v.rlike(PLACEHOLDER)) | (password & ~bad), 1).when(bad, 0))


def sampled(full: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` labelled findings, half of them of either label where there are as many, by a hash."""
    of = lambda label: full.where(F.col("label") == label).orderBy(F.xxhash64(*ID), *ID).limit(sample // 2)
    return of(1).unionByName(of(0)).select(*FEATURES, "fold", F.col("label").cast("double").alias("label"))


def scored_findings(full: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Described and labelled findings with score: of each fold by a forest of the other folds, both labels weighing the same.

    Where the other folds have fewer than FEWEST findings of a label, labels stand for themselves, and for findings of the same value
    that have none (1 before 0); the rest, which no forest has seen, are scored by a forest of all labels, or by the share of label 1 if there is one kind only (0 without any).
    """
    full = materialise(full.withColumn("fold", F.pmod(F.xxhash64("value"), F.lit(FOLDS)).cast("int")), "features")
    known = materialise(sampled(full, sample), "labelled")
    counts = {(r["fold"], int(r["label"])): r["count"] for r in known.groupBy("fold", "label").count().collect()}  # FOLDS x 2 rows
    assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
    total = {label: sum(n for (_, kind), n in counts.items() if kind == label) for label in (0, 1)}

    def by_forest(train: DataFrame, rows: DataFrame, count: dict | None = None) -> DataFrame:
        """Rows with score; with ``count``, the number of either label, both labels weigh the same."""
        weight = F.when(F.col("label") == 1, 1 / count[1]).otherwise(1 / count[0]) * (sum(count.values()) / 2) if count else F.lit(1.0)
        forest = RandomForestClassifier(labelCol="label", featuresCol="features", weightCol="weight", numTrees=TREES, maxDepth=DEPTH, seed=17)
        model = forest.fit(assemble.transform(train.withColumn("weight", weight)))
        return model.transform(assemble.transform(rows)).withColumn("score", vector_to_array("probability")[1]).select(*full.columns, "score")

    out = None
    for fold in range(FOLDS):
        own = full.where(F.col("fold") == fold)
        rest = {label: total[label] - counts.get((fold, label), 0) for label in (0, 1)}
        if min(rest.values()) >= FEWEST:
            part = by_forest(known.where(F.col("fold") != fold), own, rest)
        else:
            share = float(total[1] / max(sum(total.values()), 1))
            said = own.where("label is not null").groupBy("value").agg(F.max("label").cast("double").alias("said"))
            said = own.join(said, "value", "left").withColumn("score", F.coalesce(F.col("label").cast("double"), "said")).select(*full.columns, "score")
            part, free = said.where("score is not null"), said.where("score is null").drop("score")
            part = part.unionByName(by_forest(known, free) if min(total.values()) else free.withColumn("score", F.lit(share)))
        out = part if out is None else out.unionByName(part)
    return out


def labelled_findings(docs: DataFrame, labelled=rule_labels, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All candidates of ``docs`` with FEATURES and label."""
    words = materialise(dictionary(docs, text), "dictionary")
    logp = letter_table(words)
    found = materialise(findings(docs, doc_id, text, logp).dropDuplicates(ID), "findings")
    return labelled(describe(found, words, logp))


def scan(docs: DataFrame, labelled=rule_labels, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """One row a candidate: doc_id, row, pos (token number), value, key, score (0 to 1), secret (score >= threshold).

    ``labelled`` is a function that adds a column label (1, 0 or null) to a table of findings, from a join with
    reviewed findings for example; the default labels by rule. ``row`` is a hash of the text. Null and empty texts have
    no candidates; a text that occurs in several rows under one id is reported once. Of few labels see ``scored_findings``. An empty table gives no rows; other columns are ignored.
    """
    scored = scored_findings(labelled_findings(docs, labelled, doc_id, text), sample)
    return scored.select("doc_id", "row", "pos", "value", "key", "score", (F.col("score") >= threshold).alias("secret"))


def held_out_report(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(kind, labelled_1, labelled_0, recall, precision) of scored findings that have a label: how the forests, which saw none of them,
    answer, by kind of finding: format, private key, assigned, other."""
    kind = F.when(F.col("value").rlike(KNOWN), "format").when(F.col("key") == PEM_KEY, "private key").when((F.length("key") > 0) | F.col("before").rlike(SIGN), "assigned").otherwise("other")
    one, yes = F.col("label") == 1, F.col("score") >= threshold
    n = lambda c: F.count_if(c)
    return scored.where("label is not null").groupBy(kind.alias("kind")).agg(
        n(one).alias("labelled_1"), n(~one).alias("labelled_0"), F.try_divide(n(one & yes), n(one)).alias("recall"), F.try_divide(n(one & yes), n(yes)).alias("precision")
    )


def mask(docs: DataFrame, scanned: DataFrame, doc_id: str = "doc_id", text: str = "text", by: str = MASK) -> DataFrame:
    """``docs`` with every value that ``scanned`` calls a secret replaced in its text; other rows and columns as they are.

    Values of ``LEAST`` characters or more are replaced wherever they stand in the text, shorter ones, which may be part of
    other words, in their own tokens only. Rows are met by id, null included, and by text, so repeated ids and rows do no
    harm; null and empty texts have nothing to replace. No column of docs can clash with a name that is used here.
    """
    short = F.length("value") < LEAST
    one, row, values, places = fresh(docs, "one", "hash", "values", "places")
    hits = scanned.where("secret").groupBy(F.col("doc_id").alias(one), F.col("row").alias(row))
    hits = hits.agg(F.collect_set(F.when(~short, F.col("value"))).alias(values), F.collect_set(F.when(short, F.struct(F.col("pos").alias("pos"), F.col("value").alias("value")))).alias(places))
    key = F.xxhash64(F.col(text))
    at = F.map_from_entries(places)
    rest = lambda t: F.regexp_replace(t, ASSIGNED, "")
    own = lambda t: F.substring(t, F.lit(1), F.length(t) - F.length(rest(t)))
    cut = F.transform(F.split(F.col(text), SPLIT), lambda t, i: F.when(F.element_at(at, i).isNotNull(), F.concat(own(t), F.replace(rest(t), F.element_at(at, i), F.lit(by)))).otherwise(t))
    between = F.regexp_extract_all(F.col(text), F.lit(SPLIT), F.lit(0))
    tokens = F.when(F.size(places) > 0, F.array_join(F.zip_with(cut, between, lambda t, x: F.concat(t, F.coalesce(x, F.lit("")))), "")).otherwise(F.col(text))
    longest_first = F.array_sort(values, lambda a, b: F.length(b) - F.length(a))
    masked = F.aggregate(longest_first, tokens, lambda acc, x: F.replace(acc, x, F.lit(by)))
    out = docs.join(hits, F.col(doc_id).eqNullSafe(F.col(one)) & (key == F.col(row)), "left")
    return out.withColumn(text, F.when(F.col(values).isNotNull(), masked).otherwise(F.col(text))).select(*docs.columns)
