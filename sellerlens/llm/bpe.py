"""Byte-pair encoding by speculating and verifying, and decoding.

A word's encoding is guessed by greedy longest match over the vocabulary. The guess is right
exactly when no merge could have joined characters across any of its boundaries, and that can be
told from each pair of neighbouring tokens alone; all pairs of a batch are tested together on
arrays, and a pair's answer is kept. Words that fail are merged one step at a time, as the
vocabulary's rules say.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sellerlens.llm.common import read, text_batches

VOCABULARY = "word_bpe_49k.json"
RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
# Words whose encodings a worker keeps, in each of two generations; forgetting only costs time.
KEPT_WORDS = 250_000
KEPT_PAIRS = 1_000_000
# From so many bytes on, a word is merged over a heap.
LONG_WORD = 200

_NEVER = 1 << 60

# Texts of ASCII and small Latin-1 letters need no Unicode properties: the standard library's expressions, which
# know none, split them the same way and faster. The four separators 1C to 1F are white space to one of the two only.
_LETTERS = "A-Za-z\u00df-\u00f6\u00f8-\u00ff"
_PLAIN = re.compile(f"[^\\x00-\\x1b\\x20-\\x7f{_LETTERS}]")


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next free one from 256."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(free)) for b in range(256)]


class WordBpe:
    """A vocabulary whose words end in ``</w>``, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.names = {i: t for t, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names.update({i: t for t, i in self.special.items()})
        self.letters = _byte_letters()
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        pattern = split["pattern"]["Regex"]
        self.words = regex.compile(pattern, regex.V1)
        plain = pattern.replace(r"\p{L}", _LETTERS).replace(r"\p{N}", "0-9")
        self.plain_words = None if r"\p" in plain else re.compile(plain)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")

        size = max(self.names) + 1
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left = np.array([self.ids[a] for a, _ in merges], np.int64)
        right = np.array([self.ids[b] for _, b in merges], np.int64)
        made = np.array([self.ids[a + b] for a, b in merges], np.int64)
        self.size = size
        self.rank = dict(zip((left * size + right).tolist(), range(len(merges)), strict=True))
        self.made = made.tolist()
        # Each merged token by the merge that makes it; single characters have none.
        self.born = np.full(size, -1, np.int64)
        self.left, self.right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.born[made[::-1]] = np.arange(len(made))[::-1]
        self.left[made[::-1]], self.right[made[::-1]] = left[::-1], right[::-1]
        keys = left * size + right
        self.key_order = np.argsort(keys, kind="stable")
        self.keys = keys[self.key_order]
        self.longest = max(map(len, self.ids))
        self.known: dict[str, tuple[str, int, str]] = {}
        self.aged: dict[str, tuple[str, int, str]] = {}
        # Pairs that were tested, those that stay apart; tokens that were tested, those that are sound.
        self.judged: set[int] = set()
        self.apart: set[int] = set()
        self.weighed: set[int] = set()
        self.sound: set[int] = set()

    # --- words to tokens --------------------------------------------------------------

    def symbols(self, word: str) -> list[str]:
        """The word's bytes as letters, the last with the end mark."""
        letters = [self.letters[b] for b in word.encode("utf-8", "surrogatepass")]
        letters[-1] += self.end
        return letters

    def greedy(self, symbols: list[str]) -> list[int] | None:
        """Longest match from the left; None where no token fits."""
        ids, text, found, at = self.ids, "".join(symbols), [], 0
        count = len(symbols)
        while at < count:
            # Each symbol is one letter, but for the end mark after the last.
            for stop in range(min(count, at + self.longest), at, -1):
                token = ids.get(text[at:stop] if stop < count else text[at:])
                if token is not None:
                    found.append(token)
                    at = stop
                    break
            else:
                return None
        return found

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place of the merge of a and b among the rules; very large if there is none."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_order[at], np.int64(_NEVER))

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether tokens a and b, written next to each other, encode to a and b again.

        Merging makes both tokens by the same rules that could join them, the lowest rule first.
        So the last of the merges inside a or b is undone, again and again: the two parts that
        meet at the boundary stood there just before it, and a rule for them that comes earlier
        would have joined them. Between equal rules the left one comes first.
        """
        a, b = a.copy(), b.copy()
        good = np.ones(len(a), bool)
        # The rule applied just after this state; ``inner``: it was applied on the right side.
        until = np.full(len(a), np.int64(_NEVER))
        inner = np.zeros(len(a), bool)
        live = np.arange(len(a))
        while len(live):
            x, y = a[live], b[live]
            rule = self.rank_of(x, y)
            joined = (rule < until[live]) | ((rule == until[live]) & inner[live])
            good[live[joined]] = False
            born_x, born_y = self.born[x], self.born[y]
            go_on = ~joined & ((born_x >= 0) | (born_y >= 0))
            live, x, y = live[go_on], x[go_on], y[go_on]
            born_x, born_y = born_x[go_on], born_y[go_on]
            undo_right = born_y >= born_x  # equal rules: the right one is the later one
            until[live] = np.where(undo_right, born_y, born_x)
            inner[live] = undo_right
            a[live] = np.where(undo_right, x, self.right[x])
            b[live] = np.where(undo_right, self.left[y], y)
        return good

    def merge(self, symbols: list[str]) -> list[int]:
        """Exact merging: the lowest rule present, leftmost first, until none applies."""
        ids = [self.ids[s] for s in symbols if s in self.ids]
        get, size, made = self.rank.get, self.size, self.made
        if len(ids) > LONG_WORD:
            return self._merge_long(ids)
        ranks = [get(a * size + b, _NEVER) for a, b in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == _NEVER:
                break
            i = ranks.index(best)
            new = made[best]
            ids[i : i + 2] = [new]
            del ranks[i]
            if i:
                ranks[i - 1] = get(ids[i - 1] * size + new, _NEVER)
            if i < len(ranks):
                ranks[i] = get(new * size + ids[i + 1], _NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same for a very long word: a heap of the pairs over a linked list."""
        get, size = self.rank.get, self.size
        after = [*range(1, len(ids)), -1]
        prior = list(range(-1, len(ids) - 1))
        heap = [(r, i) for i in range(len(ids) - 1) if (r := get(ids[i] * size + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rule, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or get(ids[i] * size + ids[j]) != rule:
                continue  # one of the two was merged meanwhile
            ids[i], ids[j] = self.made[rule], -1
            after[i] = after[j]
            if after[i] >= 0:
                prior[after[i]] = i
                if (r := get(ids[i] * size + ids[after[i]])) is not None:
                    heapq.heappush(heap, (r, i))
            if prior[i] >= 0 and (r := get(ids[prior[i]] * size + ids[i])) is not None:
                heapq.heappush(heap, (r, prior[i]))
        return [x for x in ids if x >= 0]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Token ids of each word."""
        size = self.size
        symbols = [self.symbols(w) for w in words]
        guesses = [self.greedy(s) for s in symbols]
        joints = [[a * size + b for a, b in zip(g, g[1:])] if g else [] for g in guesses]
        if len(self.judged) > KEPT_PAIRS:
            self.judged.clear()
            self.apart.clear()
        asked = {k for j in joints for k in j} - self.judged
        if asked:
            keys = np.fromiter(asked, np.int64, len(asked))
            self.judged |= asked
            self.apart.update(keys[self.compatible(keys // size, keys % size)].tolist())
        for token in {t for g in guesses if g for t in g} - self.weighed:
            self.weighed.add(token)
            if self.is_sound(token):
                self.sound.add(token)
        apart, sound = self.apart.issuperset, self.sound.issuperset
        return [
            g if g and apart(j) and sound(g) else self.merge(s)
            for g, j, s in zip(guesses, joints, symbols, strict=True)
        ]

    def is_sound(self, token: int) -> bool:
        """Whether the token's own characters merge to it; a vocabulary may hold some that do not."""
        name = self.names[token]
        letters = list(name.removesuffix(self.end))
        if name.endswith(self.end) and letters:
            letters[-1] += self.end
        return self.merge(letters) == [token]

    # --- texts ------------------------------------------------------------------------

    def normal(self, text: str) -> str:
        """As the file's normaliser: composed, then each character lower-cased by itself."""
        text = unicodedata.normalize("NFC", text)
        return text.replace("Σ", "σ").lower()  # no final form of sigma

    def split(self, text: str) -> list[str]:
        """Words and special tokens of a text; the latter are found before anything else."""
        if "<|" not in text or not self.marks.search(text):
            return self.words_of(self.normal(text))
        found = []
        for piece in self.marks.split(text):
            found += [piece] if piece in self.special else self.words_of(self.normal(piece))
        return found

    def words_of(self, normal: str) -> list[str]:
        if self.plain_words is not None and not _PLAIN.search(normal):
            return self.plain_words.findall(normal)
        return self.words.findall(normal)

    def decode(self, ids: list[int]) -> str:
        """Without a decoder in the file, tokens are written as they are, one space apart."""
        return " ".join(self.names[i] for i in ids)

    def learn(self, words: set[str]) -> None:
        """Encodings of words, as text: ids, number of ids, tokens. Words not seen for long are forgotten."""
        missing = words - self.known.keys()
        if len(self.known) + len(missing) > KEPT_WORDS:
            self.aged, self.known = self.known, {}
            missing = words
        new = []
        for word in missing:
            if word in self.aged:
                self.known[word] = self.aged[word]
            elif word in self.special:
                self.known[word] = (str(self.special[word]), 1, word)
            else:
                new.append(word)
        for word, ids in zip(new, self.encode_words(new), strict=True):
            self.known[word] = (" ".join(map(str, ids)), len(ids), self.decode(ids))

    def digest_batch(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """(number of tokens, digest of the ids, digest of the decoded text) of each text."""
        out, step = [], 64
        for first in range(0, len(texts), step):
            split = [self.split(t or "") for t in texts[first : first + step]]
            self.learn({w for words in split for w in words})
            for words in split:
                known = [self.known[w] for w in words]
                ids, counts, tokens = zip(*known) if known else ((), (), ())
                out.append((
                    sum(counts),
                    hashlib.sha256(" ".join(ids).encode()).hexdigest(),
                    hashlib.sha256(" ".join(tokens).encode("utf-8", "surrogatepass")).hexdigest(),
                ))
        return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> WordBpe:
    """Once per worker process."""
    return WordBpe(path)


def encode_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row's whole text, where it lies.

    ``path`` is the vocabulary file, which every machine has. Null and empty texts have no tokens
    and the digests of the empty text. Repeated rows get repeated results, an empty table gives an
    empty result, other columns are not looked at.
    """
    out = StructType.fromDDL(RESULT)
    arrow = to_arrow_schema(out)

    def run(batches):
        bpe = vocabulary(path)
        for batch in batches:
            rows = bpe.digest_batch(batch.column(1).to_pylist())
            columns = list(zip(*rows, strict=True)) if rows else [()] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, f.type) for c, f in zip(columns, list(arrow)[1:], strict=True)]],
                schema=arrow,
            )

    slim = text_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(run, out)


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(read(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
