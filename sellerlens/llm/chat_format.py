"""Chat formatting in Spark expressions: conversations to marked texts with a loss mask, and back.

The rows of a conversation are collected and sorted, neighbouring rows of one role become one turn, and
its marks and texts are concatenated. What looks like a mark inside a text gets a backslash behind its
first character, one more if it has some already, so reading back takes away exactly one.

A conversation of very many rows or characters is formatted in segments of bounded size. They are cut between
messages, inside a turn too, and put one after the other they are the text of the whole conversation, wherever the cuts are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sellerlens.llm.common import read
from sellerlens.operators.ranking import ranked
from sellerlens.sources.scratch import materialize

# A segment has at most so many rows, and at most so many characters before its last row.
SEGMENT_ROWS = 1_000
SEGMENT_CHARS = 1 << 20


@dataclass(frozen=True)
class Template:
    """The marks around a turn and around each message in it: <s>role[INST]text[/INST]</s>.

    No mark may have, after its first character, a backslash or the first character of any.
    """

    turn: str = "<s>"
    turn_end: str = "</s>"
    message: str = "[INST]"
    message_end: str = "[/INST]"
    learned_role: str = "assistant"

    def __post_init__(self) -> None:
        firsts = {mark[:1] for mark in self.marks}
        if "" in firsts or any((firsts | {"\\"}).intersection(mark[1:]) for mark in self.marks):
            raise ValueError(f"marks cannot be told apart when escaped: {self.marks}")

    @property
    def marks(self) -> tuple[str, ...]:
        return self.turn, self.turn_end, self.message, self.message_end

    def _pattern(self, between: str) -> str:
        firsts = "".join(sorted({"\\" + mark[0] for mark in self.marks}))
        rests = "|".join(sorted({re.escape(mark[1:]) for mark in self.marks}))
        return rf"([{firsts}]){between}(?=\\*+(?:{rests}))"

    def escape(self, text: Column) -> Column:
        return F.regexp_replace(text, self._pattern(""), r"$1\\")

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, self._pattern(r"\\"), "$1")


DEFAULT = Template()


def _glued(strings: Column) -> Column:
    return F.array_join(strings, "")


def merged_turns(rows: Column) -> Column:
    """Sorted rows (turn, role, text) to turns (role, texts): neighbours of one role are one turn."""

    def add(turns: Column, row: Column) -> Column:
        last = F.element_at(turns, -1)
        alone = F.struct(row["role"].alias("role"), F.array(row["text"]).alias("texts"))
        longer = F.struct(
            last["role"].alias("role"), F.concat(last["texts"], F.array(row["text"])).alias("texts")
        )
        return F.when((F.size(turns) == 0) | (last["role"] != row["role"]), F.concat(turns, F.array(alone))).otherwise(
            F.concat(F.slice(turns, F.lit(1), F.size(turns) - 1), F.array(longer))
        )

    none = F.array().cast("array<struct<role:string,texts:array<string>>>")
    # An empty array has no last element to look at.
    return F.when(F.size(rows) == 0, none).otherwise(
        F.aggregate(
            F.slice(rows, F.lit(2), F.size(rows)),
            F.array(F.struct(rows[0]["role"].alias("role"), F.array(rows[0]["text"]).alias("texts")))
            .cast("array<struct<role:string,texts:array<string>>>"),
            add,
        )
    )


def pieces_of(turns: Column, template: Template) -> Column:
    """The strings (text, learned) that a text is put together from."""

    def piece(text: Column, learned: Column) -> Column:
        return F.struct(text.alias("text"), learned.alias("learned"))

    def mark(text: str) -> Column:
        return piece(F.lit(text), F.lit(False))

    def messages(turn: Column) -> Column:
        learned = turn["role"] == template.learned_role
        return F.flatten(F.transform(turn["texts"], lambda text: F.array(
            mark(template.message), piece(template.escape(text), learned), mark(template.message_end)
        )))

    return F.flatten(F.transform(turns, lambda turn: F.concat(
        F.array(mark(template.turn), piece(template.escape(turn["role"]), F.lit(False))),
        messages(turn),
        F.array(mark(template.turn_end)),
    )))


def learned_spans(pieces: Column) -> Column:
    """(start, end) of the learned pieces in the text, in code points, end exclusive."""

    def add(state: Column, piece: Column) -> Column:
        end = state["at"] + F.length(piece["text"])
        span = F.struct(state["at"].alias("start"), end.alias("end"))
        spans = F.when(piece["learned"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    start = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")
    )
    return F.aggregate(pieces, start, add, lambda state: state["spans"])


def _clean(conversations: DataFrame) -> DataFrame:
    empty = F.lit("")
    return conversations.select(
        "conv_id", "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")
    )


def _segments(rows: DataFrame, segment_rows: int, segment_chars: int) -> DataFrame:
    """``rows`` with block and part: the segments of each conversation, in their order, and with inside and
    open: the role of the turn that a segment begins inside of, if it does, and whether its last turn goes on behind it.

    Conversations that need several are numbered by a range sort, which cuts them between tasks wherever
    they are long; the rest is one segment each.
    """
    sizes = rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))
    # Written, so that Spark knows how few there are and need not shuffle the texts to part them.
    large = materialize(
        sizes.filter((F.col("n") > segment_rows) | (F.col("chars") > segment_chars))
        .select(F.col("conv_id").alias("_large")), "chat-large",
    )
    same = F.col("conv_id").eqNullSafe(F.col("_large"))
    whole = rows.join(large, same, "left_anti").select(
        "*", F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("part"),
        F.lit(None).cast("string").alias("inside"), F.lit(False).alias("open"),
    )
    if large.isEmpty():
        return whole
    places = ranked(
        rows.join(large, same, "left_semi"), [F.col(c) for c in ("turn", "role", "text")], by=["conv_id"], name="_rank"
    )
    block = F.call_function("div", F.col("_rank") - 1, F.lit(segment_rows))
    before = Window.partitionBy("conv_id", "block").orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    chars = F.coalesce(F.sum(F.length("text")).over(before), F.lit(0))
    cut = places.withColumn("block", block).withColumn(
        "part", F.call_function("div", chars, F.lit(max(1, segment_chars)))
    )
    return whole.unionByName(_with_borders(cut).select(whole.columns))


def _with_borders(cut: DataFrame) -> DataFrame:
    """Numbered rows in segments with the roles on their borders, from a table of one row a segment."""
    key = ("conv_id", "block", "part")
    order = Window.partitionBy("conv_id").orderBy("block", "part")
    ends = cut.groupBy(*key).agg(F.min_by("role", "_rank").alias("first"), F.max_by("role", "_rank").alias("last"))
    borders = ends.select(
        *[F.col(c).alias(f"_{c}") for c in key],
        F.when(F.lag("last").over(order) == F.col("first"), F.col("first")).alias("inside"),
        F.coalesce(F.lead("first").over(order) == F.col("last"), F.lit(False)).alias("open"),
    )
    return cut.join(borders, reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]))


def format_chats(
    conversations: DataFrame, template: Template = DEFAULT,
    segment_rows: int = SEGMENT_ROWS, segment_chars: int = SEGMENT_CHARS,
) -> DataFrame:
    """(conv_id, block, part, inside, formatted, loss_spans): each conversation's segments.

    ``formatted`` of a conversation's segments, by block and part, joined with nothing between is its text, which
    ``segment_rows`` and ``segment_chars`` do not change. ``inside`` is the role of the turn that a segment goes on with, null
    if it begins with a turn's mark.
    ``loss_spans`` holds (start, end) of every text of the learned role in ``formatted``, in code points. Rows go by
    turn, then role and text, null turns first; repeated rows are messages of their own. Null roles and texts count
    as empty. Rows without ``conv_id`` are one conversation. An empty table gives an empty result; other
    columns are not looked at.
    """
    rows = _segments(_clean(conversations), segment_rows, segment_chars)
    collected = rows.groupBy("conv_id", "block", "part", "inside", "open").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("rows")
    )
    every = pieces_of(merged_turns(F.col("rows")), template)
    # A turn that goes on has its mark and role in the segment before, its end mark in one behind.
    before, behind = F.when(F.col("inside").isNotNull(), 2).otherwise(0), F.when(F.col("open"), 1).otherwise(0)
    pieces = collected.select("*", every.alias("every")).select(
        "conv_id", "block", "part", "inside", F.slice("every", before + 1, F.size("every") - before - behind).alias("pieces")
    )
    return pieces.select(
        "conv_id", "block", "part", "inside",
        _glued(F.transform("pieces", lambda p: p["text"])).alias("formatted"),
        learned_spans(F.col("pieces")).alias("loss_spans"),
    )


def messages_in(formatted: Column, template: Template = DEFAULT, inside: Column | None = None) -> Column:
    """The messages (role, text) of a formatted text, unescaped; ``inside`` is the role of a turn it begins inside of."""

    def parts(text: Column, mark: str) -> Column:
        """What stands before each ``mark``, and behind the last one."""
        return F.split(text, re.escape(mark), -1)

    def messages(turn: Column) -> Column:
        # Without its own mark a turn begins with a message: one opened in an earlier segment.
        own = F.startswith(turn, F.lit(template.turn))
        body = F.when(own, F.substr(turn, F.lit(len(template.turn) + 1))).otherwise(turn)
        opened = F.split(body, re.escape(template.message), 2)
        role = F.when(own, template.unescape(opened[0])).otherwise(F.lit(None) if inside is None else inside)
        rest = parts(F.substr(body, F.length(opened[0]) + 1), template.message_end)
        return F.transform(F.slice(rest, F.lit(1), F.size(rest) - 1), lambda m: F.struct(
            role.alias("role"), template.unescape(F.substr(m, F.lit(len(template.message) + 1))).alias("text")
        ))

    return F.flatten(F.transform(parts(formatted, template.turn_end), messages))


def learned_texts(formatted: Column, spans: Column, template: Template = DEFAULT) -> Column:
    """The unescaped texts under the loss mask."""
    return F.transform(spans, lambda s: template.unescape(
        F.substr(formatted, s["start"] + 1, s["end"] - s["start"])
    ))


_DIGESTS = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _streamed(segments: DataFrame) -> DataFrame:
    """The digests of conversations in several segments, which go through one after the other."""
    out = StructType([segments.schema["conv_id"], *StructType.fromDDL(_DIGESTS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row() -> pa.RecordBatch:
            values = [n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars]
            return pa.RecordBatch.from_arrays([now, *(pa.array([v]) for v in values)], names=out.names)

        now = None
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[3:]]
            for i, (n_more, texts, learned, more) in enumerate(zip(*columns, strict=True)):
                if now is None or batch.column(0)[i].as_py() != now[0].as_py():
                    if now is not None:
                        yield row()
                    now = batch.column(0).slice(i, 1)
                    n, loss_chars, chars, turns, loss = 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                n, loss_chars, chars = n + n_more, loss_chars + len(learned), chars + more
                turns.update(texts.encode())
                loss.update(learned.encode())
        if now is not None:
            yield row()

    order = ["conv_id", "block", "part"]
    columns = [*order, "n_turns", "turns", "learned", "chars"]
    return segments.repartition("conv_id").sortWithinPartitions(*order).select(columns).mapInArrow(run, out)


def read_back(formatted: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """One row per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    All of it is read from formatted texts and spans. ``n_turns`` counts messages, so turns that were merged
    count as the rows they were. A conversation of one segment is digested in one expression; the segments of a larger one
    are passed through a hash in their order, so that none is ever put together.
    """
    segments = materialize(formatted, "chat-formatted")
    several = materialize(
        segments.groupBy("conv_id").agg(F.count("*").alias("_n")).filter("_n > 1")
        .select(F.col("conv_id").alias("_several")), "chat-several",
    )
    read_out = segments.select(
        "conv_id", "block", "part",
        messages_in(F.col("formatted"), template, F.col("inside")).alias("messages"),
        _glued(learned_texts(F.col("formatted"), F.col("loss_spans"), template)).alias("learned"),
        F.length("formatted").cast("long").alias("chars"),
    ).select(
        "conv_id", "block", "part", F.size("messages").cast("long").alias("n_turns"),
        _glued(F.transform("messages", lambda m: F.concat(m["role"], F.lit("\n"), m["text"], F.lit("\n")))).alias("turns"),
        "learned", "chars",
    )
    same = F.col("conv_id").eqNullSafe(F.col("_several"))
    single = read_out.join(several, same, "left_anti").select(
        "conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.col("chars").alias("formatted_chars"),
    )
    if several.isEmpty():
        return single
    return single.unionByName(_streamed(read_out.join(several, same, "left_semi")))


# A conversation whose texts are made of marks, besides those of the table.
MARKED = (-7, ("user", "assistant"), "</s>[INST] ok [/INST]")


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    conv_id, roles, text = MARKED
    extra = [
        spark.range(1).select(F.lit(conv_id).alias("conv_id"), F.lit(i).alias("turn"), F.lit(role).alias("role"),
                              F.lit(text).alias("text"))
        for i, role in enumerate(roles)
    ]
    kinds = conversations.dtypes
    rows = reduce(DataFrame.unionByName, [e.select(*[F.col(c).cast(t) for c, t in kinds]) for e in extra], conversations)
    return read_back(format_chats(rows))


OP13_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
r AS (
  SELECT *, lag(role) OVER o IS DISTINCT FROM role AS opens,
         length(regexp_replace(text, '[<\[](\\*(?:/?s>|/?INST\]))', '..\1', 'g')) AS text_chars,
         length(regexp_replace(role, '[<\[](\\*(?:/?s>|/?INST\]))', '..\1', 'g')) AS role_chars
  FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(text_chars + 13) + sum(role_chars + 7) FILTER (opens))::BIGINT AS formatted_chars
FROM r GROUP BY conv_id
"""
