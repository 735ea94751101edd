"""Small helpers the corpus operators share."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Whatever is not known to have no upper case: outside ASCII, Latin-1's small letters and signs, general
# punctuation, kana, CJK ideographs and Hangul.
_OTHER = (
    r"[^\x00-\x7F](?<![\u00A0-\u00BF\u00D7\u00DF-\u00FF\u2010-\u205E\u3000-\u30FF\u4E00-\u9FFF\uAC00-\uD7A3])"
)
# Texts in an Arrow batch.
BATCH_ROWS = 1_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else changed.

    ``lower`` is much faster than ``translate`` and does the same for texts in which nothing else
    can have an upper case.
    """
    slow = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    only_ascii = F.octet_length(text) == F.length(text)
    return F.when(~only_ascii & text.rlike(_OTHER), slow).otherwise(F.lower(text))


def reducers(spark: SparkSession) -> int:
    """How many partitions a shuffle gets here; the session's sizing, not a number of ours."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_batches(docs: DataFrame) -> DataFrame:
    """``docs``, with the session's Arrow batches made small enough for rows that are whole texts.

    A batch is held in memory on both sides, and Spark bounds its rows, not its bytes.
    """
    conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return docs


def map_texts(
    docs: DataFrame, schema: str, fn: Callable[[str], tuple], keep: Column | None = None
) -> DataFrame:
    """``keep`` (doc_id, if not given) and the columns of ``schema`` that ``fn`` gives for each whole text.

    Null texts count as empty. Texts come in Arrow batches, where they lie: no shuffle. What is kept
    is not converted on its way through Python, so nulls and large values stay as they are.
    """
    first = F.col("doc_id").cast("long").alias("doc_id") if keep is None else keep
    slim = text_batches(docs).select(first, F.coalesce("text", F.lit("")).alias("_text"))
    out = StructType([slim.schema[0], *StructType.fromDDL(schema)])
    types = list(to_arrow_schema(StructType.fromDDL(schema)))
    names = out.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [fn(text) for text in batch.column(1).to_pylist()]
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(types)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)

    return slim.mapInArrow(run, out)
