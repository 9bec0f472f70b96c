"""A bounded, repeatable sample of labelled documents, for the operators that fit a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Labelled documents that a classifier is fitted on, at most; chosen by a hash of the id.
SAMPLE = 20_000


def labelled_ids(labels: DataFrame, label: str, learn: Column, doc_id: str = "doc_id", bound: int = SAMPLE) -> DataFrame:
    """(doc_id, label) of at most ``bound`` labelled ids for which ``learn``, a Column over doc_id, holds.

    Null ids and null labels do not count; of several labels of one id the largest does. Few enough rows to broadcast.
    """
    known = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id is not null and label is not null")
    return known.where(learn).groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, doc_id: str = "doc_id", text: str = "text", bound: int = SAMPLE) -> DataFrame:
    """(doc_id, text, label): one row for each of ``labelled_ids`` that has a document.

    Of several texts of one id the smallest counts, so repeated rows cannot exceed the bound.
    """
    known = materialise(labelled_ids(labels, label, learn, doc_id, bound), "labels")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(known), "doc_id")
    return materialise(rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label")), "sample")
