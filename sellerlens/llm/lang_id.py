"""Language identification by rank-order profiles of n-grams.

A language's profile is the list of its most frequent character n-grams. A document gets a list of
the same kind, and its language is the one with the smallest out-of-place distance: the sum, over
the document's n-grams, of how far each is from its place in the profile, or the profile's length
if it is not there.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sellerlens.llm.common import map_texts, read, text_batches

# n-grams of a profile; n-grams have 1 to MAX_N characters.
PROFILE = 400
MAX_N = 3
# About how many documents a language's profile is learned from.
LEARN_DOCS = 2_000
UNKNOWN = "und"
# A text is in its language when it scores SHARE of what all but a TAIL of the language's own documents do,
# those of its length, if there are at least SIMILAR_DOCS.
TAIL, SHARE, SIMILAR_DOCS = 0.05, 0.65, 100
_BINS = 1_000  # of scores

_GAP = 1  # stands for whatever separates words
_BITS = 21  # of a code point
_CHUNK = 1 << 20


@lru_cache(maxsize=1)
def _symbols() -> np.ndarray:
    """Code point to itself for letters, to a gap for the rest."""
    table = np.full(0x110000, _GAP, np.uint32)
    letters = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]
    table[letters] = letters
    return table


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n-grams of the whole text and their counts; words are bounded by a gap.

    A very long text is counted in pieces that overlap by MAX_N - 1 characters, so memory follows
    the number of different n-grams.
    """
    chars = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    chars = _symbols()[chars]
    chars = np.concatenate(([_GAP], chars, [_GAP])).astype(np.uint64)
    chars = chars[np.r_[True, (chars[1:] != _GAP) | (chars[:-1] != _GAP)]]  # one gap between words
    codes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for start in range(0, len(chars), _CHUNK):
        piece = chars[start : start + _CHUNK + MAX_N - 1]
        grams, code = [], np.zeros(len(piece), np.uint64)
        for n in range(1, MAX_N + 1):
            firsts = min(_CHUNK, len(piece) - n + 1)
            if firsts <= 0:
                break
            code = (code[: len(piece) - n + 1] << np.uint64(_BITS)) | piece[n - 1 :]
            grams.append(code[:firsts])
        found, of = np.unique(np.concatenate(grams), return_counts=True)
        if not len(codes):
            codes, counts = found, of
        else:
            codes, where = np.unique(np.concatenate((codes, found)), return_inverse=True)
            counts = np.bincount(where, np.concatenate((counts, of))).astype(np.int64)
    return codes[codes != _GAP], counts[codes != _GAP]


def ranked_codes(codes: np.ndarray, counts: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The most frequent codes in order; equal counts are ordered by code."""
    return codes[np.lexsort((codes, -counts))[:most]]


class Profiles:
    """Profiles of all languages, as one table from n-gram to its rank in each."""

    def __init__(self, ranked: dict[str, np.ndarray]):
        self.langs = sorted(ranked)
        self.codes = np.unique(np.concatenate([ranked[x] for x in self.langs] or [np.zeros(0, np.uint64)]))
        self.ranks = np.full((len(self.langs), len(self.codes) + 1), PROFILE, np.int64)
        for row, lang in enumerate(self.langs):
            at = np.searchsorted(self.codes, ranked[lang])
            self.ranks[row, at] = np.arange(len(at))

    def predict(self, text: str) -> tuple[str, float]:
        """(language, score): 1 - distance / greatest possible distance of the best language."""
        return self.measure(text)[:2]

    def measure(self, text: str) -> tuple[str, float, int]:
        """(language, score, length class): what ``predict`` gives and the bits of the number of n-grams."""
        codes, counts = ngram_counts(text)
        if not len(codes) or not self.langs:
            return UNKNOWN, 0.0, 0
        mine = ranked_codes(codes, counts)
        at = np.searchsorted(self.codes, mine)
        at[at == len(self.codes)] = 0
        at = np.where(self.codes[at] == mine, at, len(self.codes))
        ranks = self.ranks[:, at]
        out = np.minimum(np.abs(ranks - np.arange(len(mine))), PROFILE)
        out[ranks == PROFILE] = PROFILE
        distance = out.sum(axis=1)
        best = int(distance.argmin())
        score = float(1 - distance[best] / (PROFILE * len(mine)))
        return self.langs[best], score, int(counts.sum()).bit_length()


class LeastScores:
    """The least score of a text that counts as its language's, by language and length class.

    ``histogram`` has (language, length class, score in bins) and the number of documents. Where a length
    has too few, those of the lengths next to it count too. Repeated lines and tables make
    long texts differ more than their lengths tell, so no length needs more than the language as a whole.
    """

    def __init__(self, histogram: dict[tuple[str, int, int], int]):
        by_lang: dict[str, np.ndarray] = {}
        classes = 2 + max((k for _, k, _ in histogram), default=0)
        for (lang, k, score), n in histogram.items():
            by_lang.setdefault(lang, np.zeros((classes, _BINS + 1), np.int64))[k, score] += n
        self.least = {lang: self._of(table) for lang, table in by_lang.items()}

    @staticmethod
    def _of(table: np.ndarray) -> list[float]:
        def low(rows: np.ndarray) -> float:
            below = rows.sum(axis=0).cumsum()
            return SHARE * int(np.searchsorted(below, TAIL * below[-1], side="right")) / _BINS

        least = []
        for k in range(len(table)):
            around = 0
            while around < len(table) and table[max(k - around, 0) : k + around + 1].sum() < SIMILAR_DOCS:
                around += 1
            least.append(min(low(table[max(k - around, 0) : k + around + 1]), low(table)))
        return least

    def admits(self, lang: str, score: float, length: int) -> bool:
        """Texts without a letter are in no language; one that no document was seen of admits all."""
        if lang == UNKNOWN:
            return False
        least = self.least.get(lang, [0.0])
        return score >= least[min(length, len(least) - 1)]


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _learnable(docs: DataFrame) -> DataFrame:
    return docs.filter(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull()
        & ~is_held_out(F.col("doc_id"))
    )


def learn_profiles(docs: DataFrame, learn_docs: int = LEARN_DOCS) -> Profiles:
    """Profiles from ``text`` and ``lang`` of documents that are not held out.

    About ``learn_docs`` documents a language are looked at, those whose numbers have the smallest
    hashes; where a language has fewer, all of them. The result has PROFILE n-grams a language.
    """
    usable = _learnable(docs)
    order = F.xxhash64(F.col("doc_id").cast("long"))
    sizes = usable.groupBy("lang").agg(F.count("*").alias("_n"))
    share = sizes.select("lang", F.least(F.lit(1.0), F.lit(float(learn_docs)) / F.col("_n")).alias("_share"))
    shares = {r["lang"]: r["_share"] for r in share.collect()}
    if not shares:
        return Profiles({})
    # Hashes are even over 64 bits, so a share of the documents is a share of the hashes.
    limit = F.lit(None).cast("double")
    for lang, part in shares.items():
        limit = F.when(F.col("lang") == lang, F.lit(part * 2.0**64 - 2.0**63)).otherwise(limit)
    picked = text_batches(usable).filter(order.cast("double") <= limit).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                codes, counts = ngram_counts(text)
                if lang in sums:
                    codes, where = np.unique(np.concatenate((sums[lang][0], codes)), return_inverse=True)
                    counts = np.bincount(where, np.concatenate((sums[lang][1], counts)))
                sums[lang] = codes, counts.astype(np.int64)
        for lang, (codes, counts) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes)), pa.array(codes.view(np.int64)), pa.array(counts)],
                names=["lang", "code", "n"],
            )

    best = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    top = (
        picked.mapInArrow(count, "lang string, code long, n long")
        .groupBy("lang", "code").agg(F.sum("n").alias("n"))
        .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= PROFILE)
        .orderBy("lang", "rank").collect()
    )
    ranked: dict[str, list[int]] = {lang: [] for lang in shares}
    for row in top:
        ranked[row["lang"]].append(row["code"])
    return Profiles({x: np.array(c, np.int64).view(np.uint64) for x, c in ranked.items() if c})


def identify(docs: DataFrame, profiles: Profiles, keep: Column | None = None) -> DataFrame:
    """doc_id (or ``keep``), lang_pred, score for every row, from its whole text alone, where it lies.

    Null texts and texts without a letter are ``und`` with score 0, as is everything when nothing
    was learned. Equal distances go to the language first in alphabetical order. Repeated rows get
    repeated results; an empty table gives an empty result; other columns are not looked at.
    """
    return map_texts(docs, "lang_pred string, score double", profiles.predict, keep)


def learn_least_scores(docs: DataFrame, profiles: Profiles) -> LeastScores:
    """Least scores from all documents that are not held out and are taken for what ``lang`` says.

    One pass where the texts lie; the histogram has at most _BINS rows a language and length class.
    """
    measured = map_texts(
        _learnable(docs), "found string, score double, length int", profiles.measure, F.col("lang")
    )
    counts = measured.filter(F.col("found") == F.col("lang")).groupBy(
        "lang", "length", F.floor(F.col("score") * _BINS).cast("int").alias("bin")
    ).count()
    return LeastScores({(r["lang"], r["length"], r["bin"]): r["count"] for r in counts.collect()})


def in_some_language(docs: DataFrame, profiles: Profiles, least: LeastScores, keep: Column) -> DataFrame:
    """``keep`` and whether the text is in one of the languages (``admitted``), for every row, where it lies."""
    return map_texts(docs, "admitted boolean", lambda text: (least.admits(*profiles.measure(text)),), keep)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = identify(docs, learn_profiles(docs))
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
