"""The queries of the corpus operators: thin, over the whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, decontam, embed_dedup, katz, langid, minhash, mixing, negatives, packing, quality, secrets, toxicity, urlfilter
from .common import materialise


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(n: int) -> Column:
    """crc32 of the id as text, modulo n; what splits documents into folds."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op1_katz_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.katz_scores(table(spark, sf_dir, "documents"), remainder(10) != 0)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("item_ids")


def op3_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.jaccard_join(table(spark, sf_dir, "documents"))


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), strict=False)
    return mixed.select("doc_id", F.coalesce("source", F.lit(mixing.NONE)).alias("source"), F.coalesce("lang", F.lit(mixing.NONE)).alias("lang"), "mix_topic", "mix_tokens", F.round("mix_p", 6).alias("mix_p"), F.round("mix_size", 6).alias("mix_size"), F.round("mix_error", 4).alias("mix_error"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_languages(table(spark, sf_dir, "documents"), remainder(5) != 0)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder(3) != 1)


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urlfilter.filter_urls(urlfilter.fetch_times(pages), urlfilter.derived_entries(pages))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder(4) != 2)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents")).drop("row")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings")).drop("centroid")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    vectors = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0)


def op13_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    parts = packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), ids=False)
    return packing.packed(materialise(parts, "pieces")).drop("row")


QUERIES = {
    "op1_katz_score": op1_katz_score,
    "op2_decontaminate": op2_decontaminate,
    "op3_near_vectors": op3_near_vectors,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_mix": op5_mix,
    "op6_language": op6_language,
    "op7_quality": op7_quality,
    "op8_url_filter": op8_url_filter,
    "op9_toxicity": op9_toxicity,
    "op10_secrets": op10_secrets,
    "op11_centroids": op11_centroids,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_pack": op13_pack,
}
ORACLE_SQL = {"op2_decontaminate": decontam.SQL, "op5_mix": mixing.oracle_sql(), "op8_url_filter": urlfilter.oracle_sql(), "op11_centroids": centroids.oracle_sql(), "op12_hard_negatives": negatives.SQL}
