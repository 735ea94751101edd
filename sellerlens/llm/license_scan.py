"""License scan: an exact set-similarity join of text blocks with license templates.

A block matches a template when it holds at least THRESHOLD of the template's different words, or all
of a short template's, close together.
Words are ordered by how many documents have them, rare ones first, counted over all documents.
A match of at least ``need`` of a template's n words has one of the first n - need + 1 in that
order, so only those are indexed (prefix filter); blocks with too few words are passed over (length
filter), and so is a pair whose words still to come cannot reach ``need`` (positional filter). The
rest is counted in full, so nothing that meets the threshold is missed.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sellerlens.llm.common import map_texts, read, text_batches

# Fixed phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Fixed templates: what license notices usually say, and their labels.
TEMPLATES = (
    ("mit", "released under the MIT license"),
    ("mit", "licensed under the MIT license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
            "and associated documentation files to deal in the software without restriction"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of "
               "the license at apache org licenses"),
    ("gpl", "licensed under the GNU general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the "
            "GNU general public license as published by the free software foundation"),
    ("lgpl", "licensed under the GNU lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("cc-by", "licensed under CC BY NC 4 0"),
    ("cc-by", "licensed under a creative commons attribution international license"),
    ("reserved", "copyright all rights reserved"),
)
THRESHOLD = 0.8
# Templates of fewer words hang on single ones: they have to be there as a whole, with so many others between at most.
SHORT_TEMPLATE, SHORT_SLACK = 12, 3
# A line is a block, and so are all lines as one, because a hard-wrapped notice goes over several; more words
# are cut into windows of so many, half overlapping. A notice of half a window, which is
# longer than any template by half, is in one window as a whole wherever it starts.
BLOCK_WORDS = 96

RESULT = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double"
)
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def lines_of(text: str) -> list[list[bytes]]:
    """Words of each line. In UTF-8 every character outside ASCII has bytes from 80 on only."""
    low = text.encode("utf-8", "surrogatepass").lower()  # bytes: A-Z only
    return [_WORD.findall(line) for line in low.split(b"\n")]


def blocks_of(lines: list[list[bytes]]) -> Iterator[list[bytes]]:
    """Windows over each line, and over all lines as one."""
    for words in [*lines, [w for line in lines for w in line]] if len(lines) > 1 else lines:
        if len(words) <= BLOCK_WORDS:
            yield words
        else:
            for start in range(0, len(words) - BLOCK_WORDS // 2, BLOCK_WORDS // 2):
                yield words[start : start + BLOCK_WORDS]


def base_places(words: list[bytes], present: set[bytes]) -> list[tuple[int, str]]:
    """(start, label) of every place of a phrase."""
    found = []
    for phrase, label in PHRASES.items():
        parts = phrase.encode().split()
        if present.issuperset(parts):
            n = len(parts)
            found += [
                (i, label) for i, w in enumerate(words) if w == parts[0] and words[i : i + n] == parts
            ]
    return found


def close_together(words: list[bytes], wanted: set[bytes], span: int) -> bool:
    """Whether some ``span`` words in a row hold all that are wanted, in any order."""
    last: dict[bytes, int] = {}
    for at, word in enumerate(words):
        if word in wanted:
            last[word] = at
            if len(last) == len(wanted) and at - min(last.values()) < span:
                return True
    return False


class TemplateIndex:
    """Templates in the order of word frequency, with the index over their prefixes."""

    def __init__(self, frequency: dict[bytes, int], templates=TEMPLATES, threshold: float = THRESHOLD):
        sets = [set(_WORD.findall(text.encode().lower())) for _, text in templates]
        order = sorted(set().union(*sets), key=lambda w: (frequency.get(w, 0), w))
        self.place = {w: i for i, w in enumerate(order)}
        self.labels = [label for label, _ in templates]
        # How many words in a row a short template may take up.
        self.short = {
            t: (words, len(_WORD.findall(text.encode().lower())) + SHORT_SLACK)
            for t, (words, (_, text)) in enumerate(zip(sets, templates, strict=True)) if len(words) < SHORT_TEMPLATE
        }
        self.words = [sorted(self.place[w] for w in s) for s in sets]
        self.need = [
            math.ceil(threshold * len(s) - 1e-9) if t not in self.short else len(s) for t, s in enumerate(sets)
        ]
        self.prefix: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for t, (words, need) in enumerate(zip(self.words, self.need, strict=True)):
            for position, word in enumerate(words[: len(words) - need + 1]):
                self.prefix[word].append((t, position))
        self.starts = {order[w] for w in self.prefix}

    def matches(self, block: list[bytes]) -> dict[int, float]:
        """Containment of every template that meets its threshold."""
        mine = sorted({self.place[w] for w in block if w in self.place})
        size, seen, found = len(mine), set(), {}
        for i, word in enumerate(mine):
            for t, position in self.prefix.get(word, ()):
                if t in seen:
                    continue
                need, words = self.need[t], self.words[t]
                # The first common word: what follows it on either side bounds the overlap.
                if 1 + min(len(words) - position - 1, size - i - 1) < need:
                    continue
                seen.add(t)
                common = 1 + len(set(words[position + 1 :]).intersection(mine[i + 1 :]))
                if common >= need and (t not in self.short or close_together(block, *self.short[t])):
                    found[t] = common / len(words)
        return found


def scan_text(text: str, index: TemplateIndex) -> tuple:
    lines = lines_of(text)
    words = [w for line in lines for w in line]
    present = set(words)
    places = base_places(words, present)
    best: dict[int, float] = {}
    if not present.isdisjoint(index.starts):
        for block in blocks_of(lines):
            if not index.starts.isdisjoint(block):
                for t, share in index.matches(block).items():
                    best[t] = max(share, best.get(t, 0.0))
    base = {label for _, label in places}
    starts = [start for start, _ in places]
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(base | {index.labels[t] for t in best})),
        1.0 if places else max(best.values(), default=0.0),
    )


def template_frequency(docs: DataFrame) -> dict[bytes, int]:
    """Number of documents that have each template word, over all documents: a row a word at most."""
    wanted = {w for _, text in TEMPLATES for w in _WORD.findall(text.encode().lower())}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                low = text.encode("utf-8", "surrogatepass").lower()
                total.update(wanted.intersection(_WORD.findall(low)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in total], pa.string()), pa.array(list(total.values()), pa.int64())],
            names=["word", "n"],
        )

    counts = text_batches(docs).filter("text IS NOT NULL").select("text").mapInArrow(count, "word string, n long")
    return {r["word"].encode(): r["n"] for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: places of the base phrases, labels of phrases and templates, score.

    ``score`` is 1 where a phrase stands, else the greatest containment of a template that meets the
    threshold, else 0. Null and empty texts have no words. Rows are scanned where they lie, so repeated
    rows get repeated results; an empty table gives an empty result; other columns are not looked at.
    """
    index = TemplateIndex(template_frequency(docs))
    return map_texts(docs, RESULT, lambda text: scan_text(text, index))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents"))
