"""Audit of how far the sources of a language diverge from each other and from the language.

What Spark ML's CountVectorizer does for each language, with a least document frequency and no bound
on the vocabulary: every document becomes a sparse vector of exact term counts, and a language keeps
the terms that enough of its documents have. Unlike there the vocabulary is a table and not
an array on the driver, because it grows with the corpus. The vectors of a group (language, source) are
summed, first within each task.

All arithmetic is on whole numbers. Two groups of a language are compared over the whole vocabulary,
but only terms that both have are joined: a term that a group lacks has the same share there as every
other such term, so the rest follows from how often each count occurs in a group.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sellerlens.llm.common import read, text_batches
from sellerlens.sources.scratch import materialize

LEAST_DOCUMENTS = 3
# Terms of a group that the report names.
TOP_TERMS = 200
# Shares are counted in so many parts, three times a thousand.
SCALE = 1_000_000_000
# Terms that a task holds before it hands them on.
HELD_TERMS = 300_000
# Bytes that are split into terms at once; a longer text is cut where no term stands.
CHUNK = 1 << 20

# Runs of letters. In UTF-8 every character outside ASCII has bytes from 80 on only.
_TERM = re.compile(rb"[a-z\x80-\xff]+")
_GAP = re.compile(rb"[^a-z\x80-\xff]")


def document_vector(text: bytes) -> Counter[bytes]:
    """How often each term occurs in a text, of which only A-Z are lower-cased."""
    low, start = text.lower(), 0  # bytes: A-Z only
    vector: Counter[bytes] = Counter()
    while start < len(low):
        gap = _GAP.search(low, start + CHUNK)
        end = gap.start() if gap else len(low)
        vector.update(_TERM.findall(low[start:end] if end - start < len(low) else low))
        start = end
    return vector


def group_sums(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, as partial sums of the tasks."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, Counter] = defaultdict(Counter)
        having: dict[tuple, Counter] = defaultdict(Counter)

        def held() -> Iterator[pa.RecordBatch]:
            for (lang, source), sums in counts.items():
                found, size = having[lang, source], len(sums)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()),
                        pa.array([t.decode() for t in sums], pa.string()),
                        pa.array(list(sums.values()), pa.int64()),
                        pa.array([found[t] for t in sums], pa.int64()),
                    ],
                    names=["lang", "source", "term", "n", "docs"],
                )
            counts.clear()
            having.clear()

        size = 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                vector, sums = document_vector(text), counts[lang, source]
                size -= len(sums)
                for term, n in vector.items():
                    sums[term] += n
                having[lang, source].update(vector.keys())
                size += len(sums)
                if size > HELD_TERMS:
                    yield from held()
                    size = 0
        yield from held()

    slim = text_batches(docs).select(
        F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    return slim.mapInArrow(add, "lang string, source string, term string, n long, docs long")


def kept_terms(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, source, term, n, lang_n, leads) of the terms that enough documents of the language have.

    ``lang_n`` is the term's count in the language; one of its rows has ``leads`` set, for sums over terms. A term has
    one row a source, so no term's rows are many, whatever it occurs.
    """
    term = Window.partitionBy("lang", "term")
    return (
        group_sums(docs).repartition("lang", "term")
        # Both of these keep that partitioning: one shuffle.
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .select(
            "lang", "source", "term", "n", F.sum("docs").over(term).alias("_docs"),
            F.sum("n").over(term).alias("lang_n"),
            (F.row_number().over(term.orderBy("source")) == 1).alias("leads"),
        )
        .filter(F.col("_docs") >= least_documents).drop("_docs")
    )


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(n: Column, total: Column, size: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + size)), by long division in steps of a thousand.

    Exact for counts to 9e15, where SCALE times a count would overflow from 9e9 on. Without terms there is
    nothing to share, and any divisor does.
    """
    whole, rest, digits = F.greatest(total + size, F.lit(1)), n + 1, F.lit(0)
    for _ in range(3):
        rest = rest * 1_000
        digits, rest = digits * 1_000 + _div(rest, whole), rest % whole
    return digits + 1


def divergence(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), q)


def _pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for each two groups of a language, in both directions.

    The sum over the vocabulary is that over the first one's terms, as if the other lacked them, that
    over the other's terms, as if the first lacked them, and that over the terms neither has; terms that
    both have were counted in both, which the join puts right.
    """
    mine = groups.select(
        "lang", "source", "total", "size", "terms", share(F.lit(0), F.col("total"), F.col("size")).alias("p0")
    )
    other = mine.select(
        F.col("lang"), F.col("source").alias("item"), F.col("terms").alias("item_terms"), F.col("p0").alias("q0")
    )

    def parted(df: DataFrame, source: str, item: str, value: Column) -> DataFrame:
        return df.select("lang", F.col(source).alias("source"), F.col(item).alias("item"), value.alias("value"))

    met = mine.join(other, "lang").filter("source <> item")
    neither = F.col("size") - F.col("terms") - F.col("item_terms")
    parts = [parted(met, "source", "item", neither * divergence(F.col("p0"), F.col("q0")))]

    # A group has few different counts: the terms of a count are worth the same against what the other lacks.
    same = kept.groupBy("lang", "source", "n").agg(F.count("*").alias("times")).join(mine, ["lang", "source"])
    same = same.withColumn("p", share(F.col("n"), F.col("total"), F.col("size")))
    against = same.join(other, "lang").filter("source <> item")
    sides = against.groupBy("lang", "source", "item").agg(
        F.sum(F.col("times") * divergence(F.col("p"), F.col("q0"))).alias("here"),
        F.sum(F.col("times") * divergence(F.col("q0"), F.col("p"))).alias("there"),
    )
    parts += [parted(sides, "source", "item", F.col("here")), parted(sides, "item", "source", F.col("there"))]

    weighed = kept.join(mine, ["lang", "source"]).select(
        "lang", "term", "source", share(F.col("n"), F.col("total"), F.col("size")).alias("p"), "p0"
    )
    left = weighed
    right = weighed.select(
        "lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("p0").alias("q0")
    )
    p, q, p0, q0 = (F.col(c) for c in ("p", "q", "p0", "q0"))
    common = left.join(right, ["lang", "term"]).filter("source < item").groupBy("lang", "source", "item").agg(
        F.sum(divergence(p, q) - divergence(p, q0) - divergence(p0, q) + divergence(p0, q0)).alias("here"),
        F.sum(divergence(q, p) - divergence(q, p0) - divergence(q0, p) + divergence(q0, p0)).alias("there"),
    )
    common = materialize(common, "divergence-common")
    parts += [parted(common, "source", "item", F.col("here")), parted(common, "item", "source", F.col("there"))]

    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _terms(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of the terms that a group has more of than its language."""
    joined = kept.join(groups, ["lang", "source"])
    p = share(F.col("n"), F.col("total"), F.col("size"))
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("size"))
    both = joined.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).filter("p > q")
    return both.select("lang", "source", "item", divergence(F.col("p"), F.col("q")).alias("value"))


def divergence_audit(
    docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top_terms: int = TOP_TERMS
) -> DataFrame:
    """For each (lang, source) its divergence from each other source of the language (part ``pair``) and
    its terms above the language's share (part ``term``, the first ``top_terms``), ranked by value.

    Null text, lang and source count as empty. A row is a document, so repeated rows count each. Ties
    are ranked by the item's bytes. A group without terms has its pairs; a language without kept terms
    has pairs of value 0. An empty table gives an empty result; other columns are not looked at.
    """
    kept = materialize(kept_terms(docs, least_documents), "divergence-terms")
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("terms"))
    leads = F.col("leads")
    langs = kept.groupBy("lang").agg(
        F.sum(F.when(leads, F.col("lang_n"))).alias("lang_total"), F.count_if(leads).alias("size")
    )
    named = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    numbers = ["total", "terms", "lang_total", "size"]
    groups = materialize(
        named.join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in numbers]),
        "divergence-groups",
    )
    place = F.row_number().over(
        Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    )
    pairs = _pairs(kept, groups).withColumn("rank", place)
    terms = _terms(kept, groups).withColumn("rank", place).filter(F.col("rank") <= top_terms)
    names = ["lang", "source", "part", "item", "value", "rank"]
    return (
        pairs.withColumn("part", F.lit("pair")).select(names)
        .unionByName(terms.withColumn("part", F.lit("term")).select(names))
    )


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_audit(read(spark, sf_dir, "documents"))


# The definition, over the whole vocabulary of each group.
OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
),
t AS (SELECT id, lang, source, unnest(terms) AS term FROM d),
v AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
l AS (SELECT lang, count(*) AS size, sum(n) AS total FROM v GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN v USING (lang, term) GROUP BY ALL),
n AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source),
p AS (
  SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(n.total, 0) + l.size) AS p,
         1 + (1000000000::HUGEINT * (v.n + 1)) // (l.total + l.size) AS q
  FROM g JOIN v USING (lang) JOIN l USING (lang)
  LEFT JOIN n USING (lang, source) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term
),
f AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM p WHERE n > 0 AND p > q
),
k AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r
)
SELECT * FROM k WHERE part = 'pair' OR rank <= 200
"""
