"""Document fingerprints by consistent weighted sampling.

Terms are words, their weights how often they occur. For each of SAMPLES places, gamma and uniform
variables that hang on the term alone decide which term, and which step of its weight, is the
sample; two documents share a sample with a probability that is their generalised Jaccard
similarity, sum of minima by sum of maxima of weights (Ioffe, 2010).
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sellerlens.llm.common import read, reducers, text_batches

SAMPLES = 64
_DIGITS = 4  # hexadecimal digits kept of each sample, 16 bits
# Terms whose variables a worker keeps, and terms looked at together.
_KEPT_TERMS, _BLOCK = 50_000, 8_192


def _mixed(seeds: np.ndarray) -> np.ndarray:
    """64 random bits from each 64-bit seed, by a mixing function (splitmix64)."""
    x = seeds + np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _gamma_table() -> np.ndarray:
    """Quantiles of Gamma(2, 1) at the middles of 2^16 equal steps, by Newton's method on its
    distribution function 1 - (1 + x) * exp(-x)."""
    p = (np.arange(1 << 16) + 0.5) / (1 << 16)
    x = np.sqrt(2 * p) - np.log1p(-p)
    for _ in range(60):
        x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - p) / (x * np.exp(-x)), x / 4)
    return x


class Sampler:
    """Samples of weighted term sets; keeps the variables of terms it has seen."""

    def __init__(self, samples: int = SAMPLES):
        self.samples = samples
        self.place: dict[str, int] = {}
        shape = (_KEPT_TERMS, samples)
        self.rate = np.zeros(shape, np.float32)  # r
        self.shift = np.zeros(shape, np.float32)  # beta
        self.cost = np.zeros(shape, np.float32)  # ln c - r
        self.once = np.zeros(shape, np.float32)  # ln of c / (y * e^r) for weight 1
        self.hash = np.zeros(_KEPT_TERMS, np.uint64)
        gamma = _gamma_table()
        self.spread = np.arange(samples, dtype=np.uint64)
        self.gamma, self.log_gamma = gamma.astype(np.float32), np.log(gamma).astype(np.float32)

    def _learn(self, terms: list[str]) -> None:
        """Draws the variables of at most _BLOCK terms; all kept ones go when there would be too many."""
        new = [t for t in terms if t not in self.place]
        if len(new) + len(self.place) > _KEPT_TERMS:
            self.place.clear()
            new = terms
        if not new:
            return
        hashes = np.array(
            [xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) for t in new], np.uint64
        )
        places = np.arange(self.samples, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
        bits = _mixed(hashes[:, None] + places)
        # 16 bits each choose r and c, both Gamma(2, 1); the other 32 are the uniform beta.
        r = self.gamma[bits & np.uint64(0xFFFF)]
        log_c = self.log_gamma[(bits >> np.uint64(16)) & np.uint64(0xFFFF)]
        beta = (bits >> np.uint64(32)).astype(np.float32) * np.float32(2.0**-32)
        first = len(self.place)
        to = slice(first, first + len(new))
        self.rate[to], self.shift[to], self.cost[to], self.hash[to] = r, beta, log_c - r, hashes
        self.once[to] = self.cost[to] + r * beta
        self.place.update(zip(new, range(first, first + len(new)), strict=True))

    def fingerprint(self, counts: Counter[str]) -> str:
        """Samples as hexadecimal digits; that of no terms is all zeros."""
        if not counts:
            return "0" * (self.samples * _DIGITS)
        columns = np.arange(self.samples)
        least = np.full(self.samples, np.inf, np.float32)
        chosen = np.zeros(self.samples, np.uint64)
        every, times = list(counts), np.array(list(counts.values()), np.float32)
        for begin in range(0, len(every), _BLOCK):
            terms, weight = every[begin : begin + _BLOCK], times[begin : begin + _BLOCK]
            self._learn(terms)
            at = np.array([*map(self.place.__getitem__, terms)])
            # A weight of one has the logarithm 0 and step 0: its ranks are ready.
            more = weight > 1
            once = at[~more]
            if len(once):
                rank = self.once.take(once, 0)
                best = rank.argmin(axis=0)
                low = rank[best, columns]
                better = low < least
                least[better] = low[better]
                chosen[better] = (self.hash[once[best]] + self.spread)[better]
            at = at[more]
            if len(at):
                rate, shift = self.rate.take(at, 0), self.shift.take(at, 0)
                level = np.floor(np.log(weight[more])[:, None] / rate + shift)
                rank = self.cost.take(at, 0) - rate * (level - shift)  # ln of c / (y * e^r)
                best = rank.argmin(axis=0)
                low = rank[best, columns]
                better = low < least
                least[better] = low[better]
                steps = level[best, columns].astype(np.int64).astype(np.uint64)
                code = self.hash[at[best]] + steps * np.uint64(0xA0761D6478BD642F) + self.spread
                chosen[better] = code[better]
        # Never zero, which stands for no sample.
        digits = _mixed(chosen) % np.uint64(16**_DIGITS - 1) + np.uint64(1)
        return digits.astype(">u2").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Share of equal samples; two empty documents are alike, an empty one is like no other."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(bytes.fromhex(s), np.uint16) for s in (a, b))
    return float(np.mean((x == y) & (x != 0)))


def terms_of(text: str) -> Counter[str]:
    return Counter(text.split())


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many of the following document's first."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_texts(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id, n_chars and fingerprint of every row's text, where it lies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(samples)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            prints = []
            for text in texts:
                prints.append(sampler.fingerprint(terms_of(text)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(prints, pa.string())],
                names=["doc_id", "n_chars", "fingerprint"],
            )

    slim = text_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def _with_next(docs: DataFrame) -> DataFrame:
    """Rows in blocks of neighbouring numbers, each block ended by the row that follows it.

    Columns: block, doc_id, text, last (true for the row that only follows), sorted within their
    partition. The blocks' bounds are quantiles of ``doc_id``, as many as a shuffle has
    partitions; the row after a block is the first of the next one and goes to both.
    """
    parts = reducers(docs.sparkSession)
    slim = text_batches(docs).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    # Null numbers come last: as a number they are the smallest.
    keyed = slim.withColumn("_key", F.coalesce("doc_id", F.lit(-(2**63))))
    shares = [i / parts for i in range(1, parts)] or [0.5]
    cuts = keyed.select(F.percentile_approx("_key", shares, 10_000)).first()[0]
    bounds = sorted({float(c) for c in cuts or []}) or [0.0]
    placed = Bucketizer(
        splits=[-np.inf, *bounds, np.inf], inputCol="_at", outputCol="_bucket"
    ).transform(keyed.withColumn("_at", F.col("_key").cast("double")))
    # Blocks are numbered from the largest doc_id down.
    block = F.lit(len(bounds)) - F.col("_bucket").cast("int")
    heads = {
        r["b"]: r["top"]
        for r in placed.groupBy(block.alias("b")).agg(F.max("_key").alias("top")).collect()
    }
    order = sorted(heads)
    # The first row of each block also ends the block before it; that of the first ends the last.
    before = {b: order[i - 1] for i, b in enumerate(order)}
    blocks = range(len(bounds) + 1)

    def known(values: dict[int, int]) -> Column:
        return F.element_at(
            F.array(*[F.lit(values.get(b)).cast("long") for b in blocks]), block + 1
        )

    own = F.struct(block.alias("block"), F.lit(False).alias("last"))
    end = F.struct(known(before).cast("int").alias("block"), F.lit(True).alias("last"))
    copies = F.when(known(heads) == F.col("_key"), F.array(own, end)).otherwise(F.array(own))
    return (
        placed.select("doc_id", "text", F.explode(copies).alias("to"))
        .select("to.block", "doc_id", "text", "to.last")
        # A partition each: hashed numbers would put several into one.
        .repartitionById(parts, F.col("block"))
        .sortWithinPartitions("block", "last", F.col("doc_id").desc_nulls_last(), "text")
    )


def fingerprint_edits(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are.

    The next document is the one with the next smaller ``doc_id`` (rows of the same number in the order of
    their texts, null numbers last); after the last comes the first. Null texts are empty. Each text
    crosses the network once. A table of one row is its own next; an empty one gives an empty result;
    other columns are not looked at.
    """
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    names = [part.split()[0] for part in schema.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(samples)
        held: tuple | None = None  # the row that waits for its next: block, doc_id, text, counts
        held_print: str | None = None

        def one(row: tuple, following: tuple, row_print: str | None) -> tuple[tuple, str]:
            _, doc_id, text, counts = row
            changed = edited(text, following[2])
            own = row_print or sampler.fingerprint(counts)
            other = sampler.fingerprint(terms_of(changed))
            after = sampler.fingerprint(following[3])
            digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
            out = (doc_id, len(text), digest, own, other, likeness(own, other), likeness(own, after))
            return out, after

        for batch in batches:
            rows = []
            for block, doc_id, text, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                row = (block, doc_id, text, terms_of(text))
                if held is not None and held[0] == block:
                    out, after = one(held, row, held_print)
                    rows.append(out)
                    held_print = after
                else:
                    held_print = None
                held = None if last else row
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
            )

    return _with_next(docs).mapInArrow(run, schema)


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(read(spark, sf_dir, "documents"))
