"""The corpus pipeline: quality, near duplicates, decontamination, secrets, mixing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a DataFrame; the runner
writes it and reads it again as the next stage's docs. All but the last return the columns of ``documents``, and what other
columns docs has. Rows are judged one by one: what quality, decontamination and secrets decide depends on a row's text alone,
so ids may repeat or be null. Empty tables give empty ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sporemill.llm import decontam, minhash, mixing, quality, secrets
from sporemill.llm.common import fresh, materialise, scratch_path, scratch_scope, write_table
from sporemill.llm.queries import remainder, table


def text_key(text: Column) -> Column:
    """Tells texts apart: 64 bits of a hash, and the length."""
    return F.concat_ws(":", F.hex(F.xxhash64(text)), F.length(text).cast("string"))


def without_texts(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text's key is not in ``keys`` (one column); null texts stay."""
    (key,) = fresh(docs, "key")
    return docs.join(keys.distinct().toDF(key), text_key(F.col("text")) == F.col(key), "left_anti")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rows whose text the quality classifier rejects. A text that is null or has no words is kept: there is nothing
    to judge it by. Rows with equal texts go together, whatever their ids."""
    (key,) = fresh(docs, "key")
    keyed = docs.withColumn(key, F.when(F.trim("text") != "", text_key(F.col("text"))))
    scored = quality.quality_scores(keyed, table(spark, sf_dir, "labels"), remainder(3) != 1, carry=(key,))
    return without_texts(docs, scored.where((F.col("predicted") == 0) & F.col(key).isNotNull()).select(key))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near duplicates one row: that with the smallest id, null ids last, of rows repeated under it
    any one. Rows without words are no duplicates and stay."""
    key, group = fresh(docs, "key", "group")
    # rows get numbers that the written table fixes
    keyed = materialise(docs.withColumn(key, F.monotonically_increasing_id()), "keyed")
    groups = minhash.jaccard_join(keyed, doc_id=key).select(F.col("doc_id").alias(key), F.col("group_id").alias(group))
    named = keyed.select(key, "doc_id").join(groups, key)
    kept = named.groupBy(group).agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", key)).alias("first")).select(f"first.{key}")
    return keyed.join(kept, key, "left_semi").select(*docs.columns)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rows whose text benchmark passages contaminate; null and empty texts are clean."""
    texts = docs.where("text is not null").select(text_key(F.col("text")).alias("doc_id"), "text")
    judged = decontam.decontaminate(texts, table(spark, sf_dir, "benchmark"))
    return without_texts(docs, judged.where("contaminated").select("doc_id"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in the texts, whose n_chars follow; all rows stay, null and empty texts as they are."""
    masked = secrets.mask(docs, materialise(secrets.scan(docs), "scanned"))
    return masked.withColumn("n_chars", F.when(F.col("text").contains(secrets.MASK), F.length("text").cast("long")).otherwise(F.col("n_chars")))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples rows to the target weights of source, language and topic; nulls are a value of their own. Targets that
    contradict one another are come as near to as can be, and mix_error says how near."""
    return mixing.mix(docs, strict=False)


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", uncontaminated),
    ("secret scans", without_secrets),
    ("mixing sources to target weights", mixed),
]

#: The classifier and the forest have no SQL; tests compare the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; each stage's rows are written and read again, and its scratch tables go."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        with scratch_scope(spark):
            after = stage(spark, docs, sf_dir)
            write_table(after, path)
        docs = spark.read.schema(after.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
