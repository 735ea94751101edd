"""A training-data pipeline over ``documents``: each stage works on all that the one before kept.

Stages are written as Parquet and read again; lineage ends there, and a lost executor costs no
more than the stage it was in.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sellerlens.llm.exact_dedup import exact_dedup
from sellerlens.llm.lang_id import in_some_language, learn_least_scores, learn_profiles
from sellerlens.llm.ngram_join import jaccard_components
from sellerlens.llm.packing import RANKS, VOCABULARY, pack_documents
from sellerlens.llm.surrogates import QUERY_KEY, replace_entities
from sellerlens.sources.scratch import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus has; texts without letters and alien texts go.

    How near a text has to be to its language follows the documents that the languages were learned from.
    """
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    profiles = learn_profiles(docs)
    found = in_some_language(docs, profiles, learn_least_scores(docs, profiles), row)
    kept = found.filter("admitted")
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest number."""
    judged = exact_dedup(docs, carry=F.struct(*[docs[c] for c in docs.columns]))
    return judged.filter("kept").select(*[F.col("carried")[c].alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word n-grams link, the one with the smallest number.

    Documents without n-grams are linked to none and stay. A row is told by its number and its text's
    hash, because numbers may repeat; rows without a number in a group without numbers stay.
    """
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    groups = jaccard_components(docs, mark=text_hash)
    gone = materialize(
        groups.filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).distinct(),
        "near-copies",
    )
    same = docs["doc_id"].eqNullSafe(gone["_id"]) & (text_hash == gone["_mark"])
    # As many rows may go as there are: no broadcast, at any size.
    return docs.join(gone.hint("merge"), same, "left_anti")


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts replaced by surrogates; n_chars follows the new text."""
    new = replace_entities(docs, QUERY_KEY)
    if "n_chars" not in new.columns:
        return new
    return new.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, dealt to sequences."""
    return pack_documents(docs, *(public_tokenizers.path(name) for name in (VOCABULARY, RANKS)))


STAGES: list[tuple[str, Stage]] = [
    ("language", keep_language),
    ("exact copies", drop_copies),
    ("near copies", drop_near_copies),
    ("personal data", hide_personal_data),
    ("packing", pack_sequences),
]

# The packing and the models have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
