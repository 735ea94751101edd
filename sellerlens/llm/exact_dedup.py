"""Exact de-duplication by sorting the contents.

Sampled splitters range-partition the normalised texts, each partition is sorted (Spark's sort
spills to disk), so equal texts stand next to each other, and each text is compared in full with
the one before it. Of equal texts the row with the largest ``doc_id`` stays.

The splitters are made of the first characters and a hash of a text instead of whole texts, so
what the driver samples is small whatever the lengths; comparisons are of whole texts. A text
with more copies than a fraction of a partition is spread over blocks by ``doc_id``; each block finds its
neighbours as usual, and the blocks' results, one row each, are merged by the text's digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sellerlens.llm.common import ascii_lower, read, reducers
from sellerlens.sources.scratch import materialize

# Leading characters in the splitting key.
KEY_CHARS = 32


def exact_dedup(docs: DataFrame, carry: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, and ``carry`` as
    column ``carried``.

    Null texts count as empty and form one group with the empty ones. Rows with the same text and
    the same ``doc_id`` (repeated rows) are one group of which one row is kept; a null ``doc_id`` loses
    against any other. Other columns of ``docs`` are not looked at, whatever their names. An empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    parts = reducers(spark)
    total = docs.count()
    carried = [] if carry is None else [carry.alias("carried")]
    text = F.coalesce(F.col("text"), F.lit(""))
    src = docs.select("doc_id", text.alias("text"), *carried).withColumn(
        "_norm", ascii_lower(F.col("text"))
    )
    src = src.select(
        "doc_id", "text", *(["carried"] if carried else []),
        F.substring("_norm", 1, KEY_CHARS).alias("_head"), F.xxhash64("_norm").alias("_hash"),
    )

    # Texts of more than a quarter of a mean partition: there are at most 4 * parts of them.
    heavy = (
        src.groupBy("_hash").agg(F.count("*").alias("_n"))
        .filter(F.col("_n") * (4 * parts) > F.lit(max(total, 4 * parts)))
        .select("_hash", F.lit(True).alias("_heavy"))
    )
    block = F.when(F.col("_heavy"), F.pmod(F.xxhash64("doc_id"), F.lit(parts))).otherwise(F.lit(-1))
    placed = (
        src.join(F.broadcast(heavy), "_hash", "left")
        .withColumn("_block", block).drop("_heavy")
        .repartitionByRange(parts, "_head", "_hash", "_block")
        .withColumn("_norm", ascii_lower(F.col("text")))
    )
    # Partitioned by the columns of the range partitioning, so the windows add no shuffle.
    group = ["_head", "_hash", "_block"]
    near = Window.partitionBy(*group).orderBy("_norm", F.col("doc_id").desc_nulls_last())
    before = F.lag("_norm").over(near)
    runs = placed.withColumn("_first", before.isNull() | (before != F.col("_norm"))).withColumn(
        "_run",
        F.sum(F.col("_first").cast("long")).over(
            near.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ),
    )
    runs = runs.withColumn("text_sha256", F.sha2(F.col("_norm"), 256)).drop("_norm", "text")
    run = Window.partitionBy(*group, "_run")
    runs = materialize(
        runs.select(
            "doc_id", "text_sha256", "_first", F.col("_block") >= 0,
            *(["carried"] if carried else []),
            F.max("doc_id").over(run).alias("_keep"), F.count("*").over(run).alias("_size"),
        ).withColumnRenamed("(_block >= 0)", "_split"),
        "exact-dedup",
    )
    # A row per block of each heavy text, merged to at most 4 * parts rows.
    merged = (
        runs.filter("_split AND _first")
        .groupBy("text_sha256")
        .agg(F.max("_keep").alias("_keep_all"), F.sum("_size").alias("_size_all"))
        .withColumn("_split", F.lit(True))
    )
    whole = runs.join(F.broadcast(merged), ["text_sha256", "_split"], "left")
    keep = F.when(F.col("_split"), F.col("_keep_all")).otherwise(F.col("_keep"))
    return whole.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("_size_all", "_size").alias("group_size"),
        (F.col("_first") & F.col("_keep").eqNullSafe(keep)).alias("kept"),
        "text_sha256",
        *(["carried"] if carried else []),
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


OP9_SQL = """
WITH d AS (
  SELECT doc_id,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM d
"""
