"""Best-fit packing of tokenised documents into sequences.

Only the histogram of piece lengths decides how to fill sequences. A configuration is a multiset of
lengths that fits a sequence. The linear program "fewest sequences so that every length is
covered" has too many configurations to list, so it is solved by multiplicative weights: every round
prices the lengths, a knapsack dynamic program finds the most valuable configuration, and lengths
that it covers lose weight. How many sequences each of the configurations found gets is then solved by the same
weights in finer steps. The fractional solution is rounded down, and what is left over goes
where it fits best. All of that has the size of the capacity, not of the data; pieces are then
dealt to their places by their number within their length.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sellerlens.llm.common import read, text_batches
from sellerlens.operators.ranking import ranked
from sellerlens.sources.scratch import materialize

CAPACITY = 1024
END_ID = 2
# Multiplicative weights: rounds at most, and relative coverage to stop at.
ROUNDS, ENOUGH = 1200, 1.0
# Coverage over which a weight falls to 1 / e, where steps are not larger than that.
RATE = 0.02
# The same over the configurations found; and sequences of each that rounding leaves to best fit.
FINE_ROUNDS, RESERVE = 40_000, 3
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"

# What may be a special token, and white space too long for tiktoken's pattern.
_UNUSUAL = re.compile(r"<\||\s{1000}")

Config = tuple[tuple[int, int], ...]  # ((length, copies), ...), longest first


# --- tokens -----------------------------------------------------------------------------------


class Encoder:
    """Token ids of whole texts as the tokenizers library gives them for ``path``.

    The same vocabulary as a table of ``ranks`` is several times as fast with tiktoken and gives the same
    ids, except that it knows no special tokens; texts that may hold one, or very long white space,
    go to the library itself.
    """

    def __init__(self, path: str, ranks: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(ranks, "rb") as file:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.fast = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
        )

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if _UNUSUAL.search(text):
            ids = self.library.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()


@lru_cache(maxsize=1)
def encoder(path: str, ranks: str) -> Encoder:
    """Once per worker process."""
    return Encoder(path, ranks)


def cut(length: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: full ones, the first takes what is left over."""
    first = length % capacity or capacity
    return [first] + [capacity] * ((length - first) // capacity)


def pieces(
    docs: DataFrame, path: str, ranks: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document, ``end_id`` behind its tokens.

    ``path`` and ``ranks`` are files of one vocabulary. Documents are encoded where they lie.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    mark = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path, ranks)
        for batch in batches:
            rows: list[tuple] = []
            at: list[int] = []
            for row, text in enumerate(batch.column(1).to_pylist()):
                ids = tokens.encode(text or "") + mark
                start = 0
                for piece, length in enumerate(cut(len(ids) // 4, capacity)):
                    stop = start + length
                    rows.append((piece, start, length, zlib.crc32(ids[4 * start : 4 * stop])))
                    at.append(row)
                    start = stop
            columns = list(zip(*rows, strict=True)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at, pa.int64())),
                    pa.array(columns[0], pa.int32()),
                    *[pa.array(c, pa.int64()) for c in columns[1:]],
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    slim = text_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return slim.mapInArrow(run, schema)


# --- the plan ---------------------------------------------------------------------------------


def price(values: np.ndarray, lengths: np.ndarray, limits: np.ndarray, capacity: int) -> Config:
    """The most valuable configuration: knapsack over the capacity, each length as often as it fits.

    ``limits`` are the pieces there are of each length; a configuration that asks for more of one is
    cut down to them.
    """
    worth = np.full(capacity + 1, -np.inf)
    worth[lengths] = values
    best = np.zeros(capacity + 1)  # of a room, from the greatest room down
    last = np.zeros(capacity + 1, np.int64)  # the length that is in it; 0: the best of one room less
    total = np.empty(capacity)
    for room in range(1, capacity + 1):
        # A piece of each length 1 .. room beside the best of what is left then.
        np.add(worth[1 : room + 1], best[capacity - room + 1 :], out=total[:room])
        top = int(total[:room].argmax())
        less = best[capacity - room + 1]
        if total[top] > less + 1e-12:
            best[capacity - room], last[room] = total[top], top + 1
        else:
            best[capacity - room] = less
    counts: Counter[int] = Counter()
    room = capacity
    while room > 0:
        counts[int(last[room])] += 1
        room -= int(last[room]) or 1
    place = {int(x): i for i, x in enumerate(lengths)}
    cut_down = {x: min(n, int(limits[place[x]])) for x, n in counts.items() if x}
    return tuple(sorted(((x, n) for x, n in cut_down.items() if n), reverse=True))


def configurations(histogram: dict[int, int], capacity: int, rounds: int) -> list[Config]:
    """The configurations that the program needs: in each round the most valuable one.

    Lengths are priced by their weights, which fall exponentially with how far they
    are covered, and the best configuration gets a share of the sequences that its scarcest
    length has pieces for: the smaller, the finer the prices, as far as the rounds suffice.
    """
    lengths = np.array(sorted(histogram), np.int64)
    needs = np.array([histogram[x] for x in lengths], float)
    place = {int(x): i for i, x in enumerate(lengths)}
    covered = np.zeros(len(lengths))
    coarse = min(0.5, max(0.01, len(lengths) / (2 * rounds)))
    found: set[Config] = set()
    for _ in range(rounds):
        weight = np.exp(-np.minimum((covered - covered.min()) / max(coarse, RATE), 500.0))
        config = price(weight / needs, lengths, needs, capacity)
        rows = np.array([place[x] for x, _ in config])
        copies = np.array([n for _, n in config], float)
        covered[rows] += coarse * float((needs[rows] / copies).min()) * copies / needs[rows]
        found.add(config)
        if covered.min() >= ENOUGH:
            break
    return sorted(found)


def shares(histogram: dict[int, int], configs: list[Config]) -> dict[Config, float]:
    """How many sequences of each configuration: the program over these alone, by the same weights in finer steps.

    There is no knapsack to solve here, only the configurations' values to keep up to date with the weights of
    the lengths that change, so steps can be small and many. As many sequences come out as hold the pieces of all
    lengths that some configuration has.
    """
    lengths = sorted(histogram)
    place = {x: i for i, x in enumerate(lengths)}
    rows = [np.array([place[x] for x, _ in c]) for c in configs]
    cover = [np.array([n / histogram[x] for x, n in c]) for c in configs]
    # Twenty steps to cover a length where there are as many as there can be, hundreds where there are few.
    fine = max(0.002, 2 * len(lengths) / FINE_ROUNDS)
    amount = np.array([fine / c.max() for c in cover])
    having: dict[int, list[tuple[int, float]]] = defaultdict(list)
    for k, (row, part) in enumerate(zip(rows, cover, strict=True)):
        for i, share in zip(row.tolist(), part.tolist(), strict=True):
            having[i].append((k, share))
    members = {i: (np.array([k for k, _ in m]), np.array([x for _, x in m])) for i, m in having.items()}
    weight, covered, used = np.ones(len(lengths)), np.zeros(len(lengths)), np.zeros(len(configs))
    reachable = np.array(sorted(members))
    value = np.zeros(len(configs))
    for step in range(FINE_ROUNDS):
        if step % (1 + len(configs) // 10) == 0:
            # Weights are relative to the least covered length, and sums of small changes drift.
            least = covered[reachable].min()
            if least >= 1.0:
                break
            weight = np.exp(-np.minimum((covered - least) / max(fine, RATE), 500.0))
            value[:] = 0.0
            for i, (of, part) in members.items():
                value[of] += weight[i] * part
        k = int(value.argmax())
        used[k] += amount[k]
        row = rows[k]
        covered[row] += amount[k] * cover[k]
        new = np.exp(-np.minimum((covered[row] - least) / max(fine, RATE), 500.0))
        for i, change in zip(row.tolist(), (new - weight[row]).tolist(), strict=True):
            value[members[i][0]] += change * members[i][1]
        weight[row] = new
    filled = sum(u * sum(x * n for x, n in c) for c, u in zip(configs, used.tolist(), strict=True))
    scale = sum(lengths[i] * histogram[lengths[i]] for i in members) / filled
    return {c: u * scale for c, u in zip(configs, used.tolist(), strict=True) if u}


def fullest(left: Counter[int], room: int) -> Counter[int]:
    """Pieces that leave the least of ``room`` empty, long ones first: subset sums with limits."""
    last = np.zeros(room + 1, np.int64)  # the piece that first reached a sum; 0: not reached
    reached = np.zeros(room + 1, bool)
    reached[0] = True
    for x in sorted((x for x, n in left.items() if n and x <= room), reverse=True):
        for _ in range(min(left[x], room // x)):
            new = np.zeros(room + 1, bool)
            new[x:] = reached[:-x] & ~reached[x:]
            if not new.any():
                break
            last[new] = x
            reached |= new
        if reached[room]:
            break
    filling: Counter[int] = Counter()
    at = int(np.flatnonzero(reached)[-1])
    while at:
        filling[int(last[at])] += 1
        at -= int(last[at])
    return filling


def best_fit(left: Counter[int], capacity: int) -> Counter[Config]:
    """Sequences for what rounding left over: the longest piece, then whatever fills the rest best.

    Works on counts: a filling is repeated as often as its lengths allow.
    """
    done: Counter[Config] = Counter()
    left = +left
    while left:
        longest = max(left)
        filling = fullest(left - Counter([longest]), capacity - longest) + Counter([longest])
        times = min(left[x] // n for x, n in filling.items())
        for x, n in filling.items():
            left[x] -= n * times
        left = +left
        done[tuple(sorted(filling.items(), reverse=True))] += times
    return done


def plan(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[tuple[Config, int]]:
    """(configuration, number of sequences) pairs that hold every piece of the histogram exactly once."""
    left = Counter({int(x): int(n) for x, n in histogram.items() if n})
    full: Counter[Config] = Counter()
    if left.get(capacity):  # nothing fits beside a full piece
        full[((capacity, 1),)] = left.pop(capacity)
    if not left:
        return sorted(full.items())
    found = shares(dict(left), configurations(dict(left), capacity, rounds))
    return sorted((full + dealt(left, found, capacity)).items(), reverse=True)


def dealt(histogram: Counter[int], amounts: dict[Config, float], capacity: int) -> Counter[Config]:
    """Sequences of all pieces: ``amounts`` rounded down, as far as there are pieces, then best fit.

    RESERVE sequences of each configuration are held back, so that what best fit gets still goes together.
    Their number hangs on the capacity, not on the data, so their share vanishes as the data grow.
    """
    left, chosen = Counter(histogram), Counter()
    for config, amount in sorted(amounts.items(), key=lambda s: (-s[1], s[0])):
        times = min(int(amount - RESERVE), *(left[x] // n for x, n in config))
        if times > 0:
            chosen[config] += times
            for x, n in config:
                left[x] -= n * times
    return chosen + best_fit(+left, capacity)


def pack(cut_docs: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """``cut_docs`` with sequence_id and offset: every piece in one sequence, none overfull, no gaps.

    Takes the result of ``pieces``, stored first, because the histogram and the places are read from
    it. The histogram has at most ``capacity`` rows and goes to the driver, the plan is bounded by
    capacity and rounds. Numbering the pieces of a length is a range sort, so a length that a third
    of the pieces share is spread over many tasks. Equal pieces (repeated rows) are packed one by
    one; an empty table gives an empty result.
    """
    stored = materialize(cut_docs, "pieces")
    histogram = {r["length"]: r["n"] for r in stored.groupBy("length").agg(F.count("*").alias("n")).collect()}
    shift = int(max(histogram.values(), default=1)).bit_length()
    # Places of each length in the order of the plan, in blocks of one configuration: where the block
    # starts among the places of its length, its first sequence, copies in a sequence, offset.
    rows, taken, sequence = [], Counter(), 0
    for config, times in plan(histogram, capacity, rounds):
        offset = 0
        for length, copies in config:
            rows.append((length << shift | taken[length], taken[length], sequence, copies, offset, length))
            taken[length] += copies * times
            offset += length * copies
        sequence += times
    blocks = np.array(sorted(rows), np.int64).reshape(-1, 6)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch["rank"].to_numpy() - 1
            length = batch["length"].to_numpy()
            at = np.searchsorted(blocks[:, 0], length << shift | number, side="right") - 1
            _, first, sequences, copies, offsets, _ = blocks[at].T
            nth = number - first
            yield pa.RecordBatch.from_arrays(
                [batch[n] for n in names]
                + [pa.array(sequences + nth // copies), pa.array(offsets + nth % copies * length)],
                names=[*names, "sequence_id", "offset"],
            )

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    order = [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")]
    return ranked(stored, order, by=["length"]).mapInArrow(place, schema)


def pack_documents(docs: DataFrame, path: str, ranks: str, capacity: int = CAPACITY) -> DataFrame:
    """Every document of ``docs`` tokenised with the files ``path`` and ``ranks``, cut and packed.

    Null and empty texts are one end mark. A null ``doc_id`` stays null; other columns are not looked
    at.
    """
    return pack(pieces(docs, path, ranks, capacity), capacity)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = (public_tokenizers.path(name) for name in (VOCABULARY, RANKS))
    return pack_documents(read(spark, sf_dir, "documents"), *files)
