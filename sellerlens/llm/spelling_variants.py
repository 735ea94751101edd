"""Spelling variants: words of a corpus that differ by one edit, each led to its most frequent form.

Two words at one edit share the first half of the shorter one or the rest of it, so words meet in
groups that share a half; a group too large for one task is halved again, and so on. What is
left open of a group's words is sorted, and each word scans the list behind it: the rows of its
edit matrix, three cells wide, are kept for as many characters as neighbours in the list share, and
where a row has no cell below two, the whole range that shares this prefix is passed over.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sellerlens.llm.common import read, text_batches
from sellerlens.sources.scratch import materialize

LEAST_LENGTH = 6
LEAST_COUNT = 5
# A form occurs at least so many times as often.
FORM_RATIO = 5
# One run in so many, by its hash, loses a character.
SLIP = 199
# Words that a task holds before it hands them on.
HELD_WORDS = 300_000
# A larger group is halved again. What has one character left open, or two in longer words, is never larger than the
# alphabet and its square (90 letters: 8,190 words), so every group ends up bounded.
GROUP_WORDS = 20_000
BATCH_ROWS = 10_000

_RUN = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}")
# Above every character of a word.
_LAST = "\U0010ffff"


# --- words --------------------------------------------------------------------------------------


def words_of(doc_id: str, text: bytes) -> Iterator[tuple[str, int]]:
    """(word, times) of a text, with the characters that the hash of number and run takes away."""
    start = zlib.crc32(doc_id.encode() + b":")
    # bytes.lower: A-Z only. A text that is cut here keeps whole runs, so shorter runs are never parts of longer ones.
    for run, n in Counter(_RUN.findall(text.lower().decode())).items():
        h = zlib.crc32(run.encode(), start)
        if h % SLIP == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_LENGTH:
                continue
        yield run, n


def count_words(docs: DataFrame, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that occur often enough, counted within the tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter[str] = Counter()

        def held() -> pa.RecordBatch:
            arrays = [pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.int64())]
            sums.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for word, n in words_of(doc_id, text):
                    sums[word] += n
                if len(sums) > HELD_WORDS:
                    yield held()
        yield held()

    slim = text_batches(docs).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")).cast("binary")
    )
    sums = slim.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return sums.filter(F.col("n") >= least_count)


# --- groups -------------------------------------------------------------------------------------


def halved(open_words: DataFrame) -> DataFrame:
    """Each row (word, n, least, head, tail) twice: the words that share the next half, and the rest.

    ``least`` is the length of the shorter word of a pair, ``head`` and ``tail`` are how many characters
    are shared at either end; between them ``least - head - tail`` are open, one more in a longer word.
    """
    half = F.expr("(least - head - tail) div 2").cast("int")
    sides = F.array(
        F.struct((F.col("head") + half).alias("head"), F.col("tail").alias("tail")),
        F.struct(F.col("head").alias("head"), (F.col("least") - F.col("head") - half).alias("tail")),
    )
    return (
        open_words.select("word", "n", "least", F.explode(sides).alias("side"))
        .select("word", "n", "least", "side.head", "side.tail")
        .withColumn("key", F.xxhash64(
            "least", "head", "tail", F.expr("left(word, head)"), F.expr("right(word, tail)")
        ))
    )


def meeting_groups(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, n, least, head, tail, key): the words of each group, bounded in number.

    Every pair at one edit meets in exactly one group that ``belongs`` to it.
    """
    length = F.length("word")
    pending = words.select(
        "word", "n", F.explode(F.array(length, length - 1)).alias("least"),
        F.lit(0).alias("head"), F.lit(0).alias("tail"),
    ).filter(F.col("least") >= LEAST_LENGTH)
    ready = None
    while True:
        pending = materialize(halved(pending), "variant-groups")
        heavy = materialize(
            pending.filter(F.col("least") - F.col("head") - F.col("tail") > 1)
            .groupBy("key").agg(F.count("*").alias("_n")).filter(F.col("_n") > group_words).select("key"),
            "variant-heavy",
        )
        if heavy.isEmpty():
            return pending if ready is None else ready.unionByName(pending)
        light = pending.join(heavy, "key", "left_anti").select(pending.columns)
        ready = light if ready is None else ready.unionByName(light)
        pending = pending.join(heavy, "key", "left_semi")


def belongs(common: int, least: int, head: int, tail: int) -> bool:
    """Whether a pair that shares its first ``common`` characters is this group's and no other's."""
    return common >= head and (tail == 0 or common < least - tail)


# --- the scan -----------------------------------------------------------------------------------


def prefixes_shared(parts: list[str]) -> list[int]:
    """For each part how many characters it shares with the one before it."""
    shared = [0] * len(parts)
    for i in range(1, len(parts)):
        a, b = parts[i - 1], parts[i]
        n, end = 0, min(len(a), len(b))
        while n < end and a[n] == b[n]:
            n += 1
        shared[i] = n
    return shared


def near_in_list(parts: list[str]) -> Iterator[tuple[int, int]]:
    """(i, j), i < j, of the sorted, different ``parts`` at one edit."""
    shared = prefixes_shared(parts)
    count = len(parts)
    for i in range(count - 1):
        query = parts[i]
        size = len(query)
        # rows[d]: distances of the first d characters of a part to the first d-1, d and d+1 of the query.
        rows = [(2, 0, 1)]
        j = i + 1
        while j < count:
            part = parts[j]
            del rows[min(shared[j], len(rows) - 1) + 1 :]
            d = len(rows) - 1
            a, b, c = rows[d]
            while d < len(part):
                char = part[d]
                low = b + 1 if d < 1 or d > size else min(a + (query[d - 1] != char), b + 1)
                mid = min(c, low) + 1
                if d < size:
                    mid = min(mid, b + (query[d] != char))
                high = mid + 1
                if d + 1 < size:
                    high = min(high, c + (query[d + 1] != char))
                a, b, c = low, mid, high
                d += 1
                if a > 1 and b > 1 and c > 1:
                    break
                rows.append((a, b, c))
            else:
                gap = size - len(part)
                if -1 <= gap <= 1 and (a, b, c)[gap + 1] == 1:
                    yield i, j
                j += 1
                continue
            # No cell below two: nothing that starts like this is near.
            j = bisect_left(parts, part[:d] + _LAST, j + 1)


def pairs_of_group(words: list[tuple[str, int]], least: int, head: int, tail: int) -> Iterator[tuple]:
    """(word, n, near, near_n) for each pair of a group, in both directions."""
    by_part = {word[head : len(word) - tail]: (word, n) for word, n in words}
    parts = sorted(by_part)
    for i, j in near_in_list(parts):
        if len(parts[i]) == len(parts[j]) == least - head - tail + 1:
            continue  # both are the longer word: another group's
        (a, a_n), (b, b_n) = by_part[parts[i]], by_part[parts[j]]
        common = head
        for x, y in zip(parts[i], parts[j], strict=False):
            if x != y:
                break
            common += 1
        if belongs(common, least, head, tail):
            yield a, a_n, b, b_n
            yield b, b_n, a, a_n


def near_words(words: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """(word, n, near, near_n): every two words at one edit, in both directions, each once."""
    types = [pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["word", "n", "near", "near_n"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names=names
            )

        now, group, found = None, [], []
        for batch in batches:
            for key, least, head, tail, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key, least, head, tail) != now:
                    if len(group) > 1:
                        found.extend(pairs_of_group(group, *now[1:]))
                    now, group = (key, least, head, tail), []
                    if len(found) >= BATCH_ROWS:
                        yield out(found)
                        found = []
                group.append((word, n))
        if len(group) > 1:
            found.extend(pairs_of_group(group, *now[1:]))
        yield out(found)

    order = ["key", "least", "head", "tail"]
    groups = meeting_groups(words, group_words).select(*order, "word", "n")
    lists = groups.repartition("key").sortWithinPartitions(*order)
    return lists.mapInArrow(scan, "word string, n long, near string, near_n long")


# --- forms --------------------------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for each (word, form): where the forms end.

    Each round every word jumps to where its present goal goes. A form occurs several times as often
    as its word, so a way has a length of the logarithm of the greatest count, and the rounds that of its length.
    """
    now = materialize(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        after = materialize(now.join(further, "root", "left"), "variant-roots")
        if after.filter("_next IS NOT NULL").isEmpty():
            return now
        now = after.select("word", F.coalesce("_next", "root").alias("root"))


def group_variants(
    docs: DataFrame, least_count: int = LEAST_COUNT, ratio: int = FORM_RATIO, group_words: int = GROUP_WORDS
) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    Null texts have no words, a null ``doc_id`` counts as empty in the hash, and repeated rows count each.
    Of near words that occur equally often the first in code-point order is the form. An empty
    table gives an empty result; other columns are not looked at.
    """
    words = materialize(count_words(docs, least_count), "variant-words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    near = near_words(words, group_words).groupBy("word", "n").agg(
        F.count("*").alias("n_near"), best.alias("best")
    )
    often = -F.col("best.less") >= ratio * F.col("n")
    near = materialize(
        near.select(
            "word", "n_near", F.when(often, F.col("best.near")).alias("form"),
            F.when(often, -F.col("best.less")).alias("form_n"),
        ),
        "variant-forms",
    )
    led = roots(near.filter("form IS NOT NULL"))
    return (
        words.join(near, "word", "left").join(led, "word", "left")
        .select(
            "word", "form", F.coalesce("root", "word").alias("root"), "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n",
        )
    )


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(read(spark, sf_dir, "documents"))


# Near words by what is left when one character goes; the hash by its table.
OP12_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i, 0 AS k, i::BIGINT AS c FROM range(256) r(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
),
tab AS (SELECT list(c ORDER BY i) AS crc FROM bits WHERE k = 8),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[a-z\x{C0}-\x{FF}]+')) AS run
  FROM documents
),
counted AS (
  SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS hx
  FROM runs WHERE length(run) >= 6 GROUP BY ALL
),
bytes AS (
  SELECT doc_id, run, n, list_transform(
           range(length(hx) // 2),
           lambda i: (instr('0123456789ABCDEF', substr(hx, 2 * i + 1, 1)) - 1) * 16
                     + instr('0123456789ABCDEF', substr(hx, 2 * i + 2, 1)) - 1) AS b
  FROM counted
),
hashed AS (
  SELECT run, n, xor(list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(b, lambda x: x::BIGINT)),
           lambda c, x: xor(c >> 8, tab.crc[1 + (xor(c, x) & 255)])), 4294967295) AS h
  FROM bytes, tab
),
slipped AS (
  SELECT CASE WHEN h % 199 = 0
              THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2)
              ELSE run END AS word, n
  FROM hashed
),
w AS (
  SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 6
  GROUP BY word HAVING sum(n) >= 5
),
less AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)
),
near AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n
  FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT a.word, a.n, b.word, b.n FROM less a JOIN w b ON a.rest = b.word
  UNION
  SELECT b.word, b.n, a.word, a.n FROM less a JOIN w b ON a.rest = b.word
),
best AS (
  SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place,
         count(*) OVER (PARTITION BY word) AS n_near
  FROM near
),
f AS (SELECT word, near AS form, near_n AS form_n FROM best WHERE place = 1 AND near_n >= 5 * n),
steps AS (
  SELECT word, form AS root FROM f
  UNION ALL
  SELECT s.word, f.form FROM steps s JOIN f ON f.word = s.root
),
ends AS (SELECT word, root FROM steps WHERE root NOT IN (SELECT word FROM f))
SELECT w.word, f.form, coalesce(e.root, w.word) AS root, w.n, coalesce(b.n_near, 0) AS n_near, f.form_n
FROM w LEFT JOIN f USING (word) LEFT JOIN ends e USING (word)
LEFT JOIN best b ON b.word = w.word AND b.place = 1
"""
