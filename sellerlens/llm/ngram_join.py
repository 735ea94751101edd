"""N-gram Jaccard join: documents whose sets of word 5-grams are at least 80 % alike, exactly.

The join itself is a prefix-tree join: n-gram sets in one global order, frequent ones first, share the path of
their common beginning in a trie, a probing set walks it, carries the overlap of a path down to all that
share it, and leaves a subtree once the lengths that remain cannot lift the overlap enough. Every link
between different sets is found and counted, whether they are connected already or not.

Which sets have to meet is found before, by filters that never lose a link:

* Documents with the same set are one class; one of them stands for all.
* Two linked sets x and y agree in all but a fifth of either. So their ``extra`` smallest common
  n-grams (by hash) are among the smallest |x| / 5 + extra of x, and likewise of y. Only those,
  three in ten, cross the network, and a set of which too few are shared with any other is out.
* Of these n-grams the rarest come first in a second order. Linked sets share one of the first
  ones even if the most frequent ``extra`` - 1 are left out. So passages that many
  documents share do not bring documents together that share nothing else.
* Sets that share such an n-gram are joined to candidate groups; a group, or a pair of its blocks where
  it is too large for one task, is what a trie is built for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sellerlens.llm.common import map_texts, read, text_batches
from sellerlens.llm.components import components
from sellerlens.sources.scratch import materialize

N = 5
# N-grams that are sent to one bucket, held together on the sending side, and joined in one task.
BUCKET, CHUNK, UNIT = 1_000_000, 1_000_000, 500_000
# An n-gram of so many documents in one chunk counts as frequent everywhere; it comes last.
FREQUENT = 8
_HOT = 1 << 30

_P = [np.uint64(p) for p in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 1)]


def ngram_set(text: str) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct 5-grams of words; fewer words are one n-gram."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z, ASCII white space
    count = len(words)
    if not count:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, count)
    if count < N:
        return np.array([xxhash.xxh3_64_intdigest(h.tobytes(), seed=count)], np.uint64)
    x = sum(h[i : count - N + 1 + i] * _P[i] for i in range(N))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    return np.unique(x)


def set_id(grams: np.ndarray) -> int:
    """64 bits that stand for a whole set, as a signed number."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())).astype(np.int64))


def extra(n: int) -> int:
    return n // 10 + 1


def sent(n: int) -> int:
    """How many of a set's smallest n-grams are sent."""
    return min(n, n // 5 + extra(n))


# --- who has to meet --------------------------------------------------------------------------


def _postings(docs: DataFrame, buckets: int) -> DataFrame:
    """(set, gram, frequency) of all sent n-grams that another set has sent too, frequent ones at the end.

    Each chunk of documents sends, for each bucket of n-grams, their hashes and sets as bytes. An
    n-gram of many sets in a chunk is only reported as frequent, with its sets on another way, so a
    bucket gets at most FREQUENT postings of an n-gram from a chunk.
    """

    def chunk_rows(grams: np.ndarray, owner: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(grams, kind="stable")
        grams, owner = grams[order], owner[order]
        _, first, where, count = np.unique(grams, return_index=True, return_inverse=True, return_counts=True)
        hot = count[where] >= FREQUENT
        bucket = ((grams >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        low = grams.astype(np.uint32)
        heads = first[count >= FREQUENT]
        # Sets of frequent n-grams go by their own number: it spreads them.
        direct = (owner[hot].view(np.uint64) % np.uint64(buckets)).astype(np.int64)
        full = bucket[hot] << 32 | low[hot]
        to = np.concatenate((bucket[~hot], bucket[heads], direct))
        a = np.concatenate((low[~hot].astype(np.int64), low[heads].astype(np.int64), full))
        b = np.concatenate((owner[~hot], np.zeros(len(heads), np.int64), owner[hot]))
        kind = np.repeat([0, 1, 2], [int((~hot).sum()), len(heads), int(hot.sum())])
        order = np.lexsort((kind, to))
        to, a, b, kind = to[order], a[order], b[order], kind[order]
        cuts = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else np.zeros(0, np.int64)
        rows: list[tuple] = []
        for lo, hi in zip(cuts, np.r_[cuts[1:], len(to)], strict=True):
            p, q = (lo + np.searchsorted(kind[lo:hi], k) for k in (1, 2))
            rows.append((int(to[lo]), a[lo:p].astype(np.uint32).tobytes(), b[lo:p].tobytes(),
                         a[p:q].astype(np.uint32).tobytes(), a[q:hi].tobytes(), b[q:hi].tobytes()))
        columns = list(zip(*rows, strict=True)) if rows else [()] * 6
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
            names=["bucket", "grams", "sets", "frequent", "hot_grams", "hot_sets"],
        )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        grams, owners, size = [], [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = ngram_set(text)
                who = set_id(found)
                if not len(found) or who in seen:
                    continue
                seen.add(who)
                part = found[: sent(len(found))]
                grams.append(part)
                owners.append(np.full(len(part), who, np.int64))
                size += len(part)
                if size >= CHUNK:
                    yield chunk_rows(np.concatenate(grams), np.concatenate(owners))
                    seen, grams, owners, size = set(), [], [], 0
        if size:
            yield chunk_rows(np.concatenate(grams), np.concatenate(owners))

    def count(table: pa.Table) -> pa.Table:
        def joined(name: str, kind: type) -> np.ndarray:
            return np.frombuffer(b"".join(table[name].to_pylist()), kind)

        bucket = table["bucket"][0].as_py()
        grams, sets = joined("grams", np.uint32), joined("sets", np.int64)
        order = np.lexsort((sets, grams))
        grams, sets = grams[order], sets[order]
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (sets[1:] != sets[:-1])
        grams, sets = grams[new], sets[new]
        different, number = np.unique(grams, return_counts=True)
        frequent = np.isin(different, joined("frequent", np.uint32))
        of_pair = np.repeat(np.where(frequent, _HOT, number), number)
        shared = of_pair > 1
        direct, direct_sets = joined("hot_grams", np.int64), joined("hot_sets", np.int64)
        return pa.table({
            "set": np.concatenate((sets[shared], direct_sets)),
            "gram": np.concatenate((bucket << 32 | grams[shared].astype(np.int64), direct)),
            "frequency": np.concatenate((of_pair[shared], np.full(len(direct), _HOT))).astype(np.int64),
        })

    schema = "bucket long, grams binary, sets binary, frequent binary, hot_grams binary, hot_sets binary"
    texts = text_batches(docs).filter("text IS NOT NULL").select("text")
    return (
        texts.mapInArrow(send, schema).groupBy("bucket")
        .applyInArrow(count, "set long, gram long, frequency long")
        # Sets of frequent n-grams may come from several chunks.
        .repartition("set").dropDuplicates(["set", "gram"])
    )


def candidate_groups(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(set, group) of all sets that may be linked to another; linked sets have the same group."""
    total = classes.agg(F.sum((F.col("n") * 0.3 + 1) * F.col("copies"))).first()[0] or 0
    shared = _postings(docs, int(total // BUCKET) + 1)
    # Least number of shared n-grams with a partner, which may be a fifth shorter.
    least = F.floor(F.ceil(F.col("n") * 4 / 5) / 10) + 1
    of_set = Window.partitionBy("set")
    chosen = materialize(
        shared.join(classes.groupBy("set").agg(F.min("n").alias("n")), "set")
        .withColumn("common", F.count("*").over(of_set))
        .withColumn("place", F.row_number().over(of_set.orderBy("frequency", "gram")))
        .filter(F.col("place") <= F.col("common") - least + 1)
        .select("set", "gram"),
        "ngram-chosen",
    )
    first = chosen.groupBy("gram").agg(F.min("set").alias("first"), F.count("*").alias("sets"))
    edges = chosen.join(first.filter("sets > 1"), "gram").select(
        F.col("set").alias("a"), F.col("first").alias("b")
    )
    return components(edges).select(F.col("node").alias("set"), F.col("root").alias("group"))


# --- the trie ---------------------------------------------------------------------------------

# A node with more branches is not walked further: what is left of the sets below it is counted at once.
FEW = 4


class Trie:
    """Sets of ranks in one order, as a tree: a node is a run of ranks that all sets below it share.

    Sets are kept sorted, so the sets below a node are a range of them, and one after the other in one array.
    The rarest n-grams have the greatest ranks.
    """

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        self.sets = [sets[i] for i in self.order]
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.flat = np.concatenate(self.sets)
        common = [0]
        for x, y in zip(self.sets, self.sets[1:]):
            n = min(len(x), len(y))
            other = np.flatnonzero(x[:n] != y[:n])
            common.append(int(other[0]) if len(other) else n)
        self.common = np.array(common, np.int64)
        self.known: dict[tuple[int, int, int], tuple[np.ndarray, dict[int, int]]] = {}

        # Where each rank stands among the rarest of a set: linked sets share one of those.
        rare = [s[-(len(s) // 5 + 1) :] for s in self.sets]
        ranks = np.concatenate(rare)
        owners = np.repeat(np.arange(len(sets)), [len(r) for r in rare])
        order = np.argsort(ranks, kind="stable")
        self.owners = owners[order]
        self.starts = np.searchsorted(ranks[order], np.arange(int(ranks.max()) + 2))

    def sharing(self, ranks: np.ndarray) -> np.ndarray:
        """Places of the sets that have one of these ranks among their rarest."""
        ranks = ranks[ranks < len(self.starts) - 1]
        found = np.zeros(len(self.sets), bool)
        for a, b in zip(self.starts[ranks].tolist(), self.starts[ranks + 1].tolist()):
            found[self.owners[a:b]] = True
        return np.flatnonzero(found)

    def branches(self, low: int, high: int, depth: int) -> tuple[np.ndarray, dict[int, int]]:
        """First sets of the ranges below a node at ``depth``; how deep a range agrees, once asked for."""
        key = (low, high, depth)
        if key not in self.known:
            cuts = low + 1 + np.flatnonzero(self.common[low + 1 : high] == depth)
            self.known[key] = (np.r_[low, cuts, high], {})
        return self.known[key]

    def depth(self, low: int, high: int) -> int:
        return int(self.common[low + 1 : high].min()) if high - low > 1 else len(self.sets[low])

    def held(self, places: np.ndarray, depth: int, has: np.ndarray) -> np.ndarray:
        """How many of a probe's ranks (``has``) each of these sets holds behind ``depth``."""
        ends = self.ends[places]
        starts = ends - self.sizes[places] + depth
        low, high = int(starts[0]), int(ends[-1])
        if high - low > 4 * int((ends - starts).sum()):
            return np.array([np.count_nonzero(has[self.flat[a:b]]) for a, b in zip(starts, ends)], np.int64)
        seen = np.zeros(high - low + 1, np.int64)
        np.cumsum(has[self.flat[low:high]], out=seen[1:])
        return seen[ends - low] - seen[starts - low]

    def linked(self, mine: np.ndarray, has: np.ndarray, behind: int = -1) -> np.ndarray:
        """Places of all sets linked with the probe, of those behind a place."""
        size = len(mine)
        goals = self.sharing(mine[-(size // 5 + 1) :])
        goals = goals[goals > behind]
        sizes = self.sizes[goals]
        goals = goals[(sizes >= -(-4 * size // 5)) & (sizes <= size * 5 // 4)]
        found = [goals[:0]]
        stack = [(0, len(self.sets), 0, 0, goals)] if len(goals) else []
        while stack:
            low, high, depth, overlap, goals = stack.pop()
            cuts, depths = self.branches(low, high, depth)
            branch = np.searchsorted(cuts, goals, side="right") - 1
            taken = np.unique(branch)
            if len(taken) > FEW:
                whole = overlap + self.held(goals, depth, has)
                found.append(goals[whole >= least_common(size, self.sizes[goals])])
                continue
            for i in taken.tolist():
                a, b = int(cuts[i]), int(cuts[i + 1])
                inside = goals[branch == i]
                if a not in depths:
                    depths[a] = self.depth(a, b)
                down = depths[a]
                run = self.sets[a][depth:down]
                here = overlap + int(np.count_nonzero(has[run]))
                # What can still be added: the rest of either set beyond this node.
                rest = size - int(np.searchsorted(mine, run[-1], side="right")) if len(run) else size
                fits = self.sizes[inside]
                inside = inside[here + np.minimum(fits - down, rest) >= least_common(size, fits)]
                if len(inside) and b - a > 1:
                    stack.append((a, b, down, here, inside))
                else:  # a leaf: nothing is left to add, so the overlap is enough
                    found.append(inside)
        return np.sort(np.concatenate(found))


def least_common(size: int, sizes: np.ndarray) -> np.ndarray:
    """Linked: 100 * i >= 80 * (a + b - i), so i >= 4 * (a + b) / 9."""
    return -(-4 * (size + sizes) // 9)


def linked_sets(sets: list[np.ndarray], block: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(i, sets linked with set i): every link once, with one of its two sets.

    With ``block`` (0 or 1 a set) only links between the blocks are looked for: the sets of block 0 are in the trie, those
    of block 1 walk it.
    """
    grams, inverse = np.unique(np.concatenate(sets), return_inverse=True)
    counts = np.bincount(inverse, minlength=len(grams))
    # Frequent n-grams first: they are what sets have in common.
    rank_of = np.empty(len(grams), np.int64)
    rank_of[np.lexsort((grams, -counts))] = np.arange(len(grams))
    ends = np.cumsum([len(s) for s in sets])[:-1]
    ranked = [np.sort(r) for r in np.split(rank_of[inverse], ends)]
    inner = np.arange(len(sets)) if block is None else np.flatnonzero(block == 0)
    if not len(inner):
        return
    trie = Trie([ranked[i] for i in inner])
    names = inner[trie.order]
    has = np.zeros(len(grams), bool)
    # Within a block each set looks for those behind it in the trie.
    for at, probe in enumerate(names.tolist()) if block is None else ((-1, i) for i in np.flatnonzero(block == 1).tolist()):
        has[ranked[probe]] = True
        found = trie.linked(ranked[probe], has, at)
        has[ranked[probe]] = False
        if len(found):
            yield probe, names[found]


class Forest:
    """Connected components within a unit: what is left to do across units is one edge a set."""

    def __init__(self, size: int):
        self.label = np.arange(size)

    def join(self, one: int, others: np.ndarray) -> None:
        labels = np.unique(np.append(self.label[others], self.label[one]))
        if len(labels) > 1:
            self.label[np.isin(self.label, labels)] = labels[0]


def dealt_to_units(sets: DataFrame) -> DataFrame:
    """Rows (set, group, n, copies, grams) once for each unit of work (u, s, x, y, kind) that they are part of, on one
    ``side`` of it.

    Groups are dealt to units by size. A group too large for a unit is cut into blocks of sets, by
    size and hash, and each two blocks that may hold linked sets are a unit: sets with more than a quarter more n-grams
    cannot be linked.
    """
    sizes = sets.groupBy("group").agg(F.sum("n").alias("size"))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    units = int(total // UNIT) + 1
    # Sizes that differ by a quarter at most are one class apart, or in the same one.
    scale = F.floor(F.log(F.col("n").cast("double")) / math.log(1.26)).cast("long")
    of_scale = sets.groupBy("group", scale.alias("scale")).agg(F.sum("n").alias("held"))
    large = materialize(
        of_scale.join(sizes.filter(F.col("size") > UNIT), "group")
        .select("group", "scale", F.ceil(F.col("held") / UNIT).cast("long").alias("blocks")),
        "ngram-blocks",
    )
    ups = large.select("group", (F.col("scale") - 1).alias("scale"), F.col("blocks").alias("above"))
    downs = large.select("group", (F.col("scale") + 1).alias("scale"), F.col("blocks").alias("below"))
    shape = large.join(ups, ["group", "scale"], "left").join(downs, ["group", "scale"], "left")
    shape = shape.select("group", "scale", "blocks", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("above", "below")])

    here = F.pmod(F.xxhash64("set"), F.col("blocks"))
    own, low = F.lit(0).cast("long"), F.lit(-1).cast("long")

    def unit(u: Column, scale_: Column, x: Column, y: Column, kind: int, side: Column) -> Column:
        return F.struct(
            u.alias("u"), scale_.alias("s"), x.alias("x"), y.alias("y"), F.lit(kind).alias("kind"), side.alias("side")
        )

    def others(count: Column) -> Column:
        """Numbers of so many blocks, none of none."""
        return F.slice(F.sequence(own, count), F.lit(1), count.cast("int"))

    zero, one = F.lit(0), F.lit(1)
    placed = sets.withColumn("scale", scale).join(shape, ["group", "scale"], "left")
    small = F.array(unit(F.pmod(F.xxhash64("group"), F.lit(units)), low, low, low, 0, zero))
    # Blocks of one class: each with itself, and each two. Of two classes: each of one with each of the other.
    same = F.transform(others(F.col("blocks")), lambda o: F.when(
        o == here, unit(F.col("group"), F.col("scale"), here, here, 1, zero)
    ).otherwise(unit(
        F.col("group"), F.col("scale"), F.least(o, here), F.greatest(o, here), 1, F.when(here > o, one).otherwise(zero)
    )))
    upward = F.transform(others(F.col("above")), lambda o: unit(F.col("group"), F.col("scale"), here, o, 2, zero))
    downward = F.transform(others(F.col("below")), lambda o: unit(F.col("group"), F.col("scale") - 1, o, here, 2, one))
    where = F.when(F.col("blocks").isNull(), small).otherwise(F.concat(same, upward, downward))
    return placed.withColumn("unit", F.explode(where)).select("unit.*", "set", "group", "copies", "grams")


def _links(sets: DataFrame) -> DataFrame:
    """(a, b, n) from rows (set, group, n, copies, grams): set a is linked with n documents of other sets, and is in one
    component with set b. A set has a row for each unit of work in which it has links.
    """
    dealt = dealt_to_units(materialize(sets, "ngram-sets"))

    def join(table: pa.Table) -> pa.Table:
        group, names, side = (table[c].to_numpy() for c in ("group", "set", "side"))
        copies = table["copies"].to_numpy()
        between = table["kind"][0].as_py() == 2 or table["x"][0].as_py() != table["y"][0].as_py()
        grams = table["grams"].to_pylist()
        order = np.lexsort((names, group))
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        cuts = np.flatnonzero(np.r_[True, group[order][1:] != group[order][:-1], True])
        for lo, hi in zip(cuts, cuts[1:]):
            rows = order[lo:hi]
            rows = rows[np.unique(names[rows], return_index=True)[1]]  # repeated rows of one set
            if len(rows) < 2:
                continue
            forest, count = Forest(len(rows)), np.zeros(len(rows), np.int64)
            found = linked_sets([np.frombuffer(grams[r], np.uint64) for r in rows], side[rows] if between else None)
            for i, partners in found:
                count[i] += copies[rows[partners]].sum()
                count[partners] += copies[rows[i]]
                forest.join(i, partners)
            some = np.flatnonzero(count)
            out.append((names[rows[some]], names[rows[forest.label[some]]], count[some]))
        a, b, n = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
        return pa.table({"a": a, "b": b, "n": n})

    return dealt.groupBy("u", "s", "x", "y", "kind").applyInArrow(join, "a long, b long, n long")


# --- documents --------------------------------------------------------------------------------


def jaccard_components(docs: DataFrame, mark: Column | None = None) -> DataFrame:
    """doc_id, n_shingles, n_links, component_id for every row of ``docs``, and ``mark`` as column mark, if given.

    ``n_links`` is how many other rows the row is linked with, ``component_id`` the smallest ``doc_id`` that can be
    reached by links. Null texts and texts without
    words have no n-grams and are alone. Equal rows are in one component; a null ``doc_id`` counts as no
    number, so a component of such rows alone has none. An empty table gives an empty result;
    other columns are not looked at.
    """
    marks = [] if mark is None else [mark.alias("mark")]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *marks)
    keep = F.struct("doc_id", *(["mark"] if marks else [])).alias("of")

    def measure(text: str) -> tuple[int, int]:
        grams = ngram_set(text)
        return len(grams), set_id(grams)

    measured = map_texts(docs, "n long, set long", measure, keep)
    sets = materialize(measured.select("of.*", "n", "set"), "ngram-documents")
    classes = materialize(
        sets.filter("n > 0").groupBy("set", "n").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")),
        "ngram-classes",
    )
    groups = candidate_groups(docs, classes)

    # The texts that stand for candidate classes; a number may have several texts.
    key = F.coalesce("doc_id", F.lit(-(2**63)))
    wanted = materialize(
        classes.join(groups, "set").select(
            F.coalesce("first", F.lit(-(2**63))).alias("key"), "set", "group", "n", "copies"
        ),
        "ngram-wanted",
    )
    # Both sides are shuffled at every size: the list of candidates has no bound, and what is
    # small enough to broadcast today changes the plan, not the need.
    texts = docs.filter("text IS NOT NULL").withColumn("key", key).join(wanted.hint("merge"), "key").select(
        "set", "group", "n", "copies", "text"
    )

    def grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [ngram_set(t) for t in batch["text"].to_pylist()]
            right = pa.array([set_id(g) == s for g, s in zip(found, batch["set"].to_pylist(), strict=True)],
                             pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch["set"], batch["group"], batch["n"], batch["copies"],
                 pa.array([g.tobytes() for g in found], pa.binary())],
                names=["set", "group", "n", "copies", "grams"],
            ).filter(right)

    links = materialize(
        _links(texts.mapInArrow(grams_of, "set long, group long, n long, copies long, grams binary")), "ngram-links"
    )
    linked = components(links.select("a", "b"))
    counts = links.groupBy("a").agg(F.sum("n").alias("others"))
    joined = (
        classes.join(linked, classes["set"] == linked["node"], "left")
        .join(counts, classes["set"] == counts["a"], "left")
        .select("set", "n", "first", F.coalesce("root", "set").alias("root"),
                (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    )
    least = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    of_class = materialize(
        joined.join(least, "root").select("set", "n", "n_links", "component_id"), "ngram-components"
    )
    shown = ["mark"] if marks else []
    found = sets.filter("n > 0").join(of_class, ["set", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "n_links", "component_id", *shown
    )
    alone = sets.filter("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.lit(0).cast("long").alias("n_links"),
        F.col("doc_id").alias("component_id"), *shown
    )
    return found.unionAll(alone)


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents"))


OP8_SQL = """
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
grams AS (
  SELECT doc_id, unnest(CASE
           WHEN len(w) = 0 THEN []
           WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_distinct(list_transform(range(1, len(w) - 3),
                                             lambda i: array_to_string(w[i : i + 4], ' '))) END) AS gram
  FROM split),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * common >= 80 * (p.n + q.n - common)),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r
  JOIN (SELECT x AS a, y AS b FROM links UNION ALL SELECT y, x FROM links) l ON l.a = r.other)
counted AS (SELECT doc_id, count(*) AS n_links
  FROM (SELECT x AS doc_id FROM links UNION ALL SELECT y FROM links) GROUP BY doc_id)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, coalesce(any_value(n_links), 0) AS n_links,
       min(other) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) LEFT JOIN counted USING (doc_id) GROUP BY doc_id
"""
