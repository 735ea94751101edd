"""The source audit, spelling variants and chat formatting against plain versions of their definitions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pytest
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from sellerlens.llm import chat_format, source_divergence, spelling_variants
from sellerlens.llm.chat_format import OP13_SQL
from sellerlens.llm.source_divergence import OP11_SQL
from sellerlens.llm.spelling_variants import OP12_SQL


def by_sql(sql, **tables):
    duck = duckdb.connect()
    for name, df in tables.items():
        duck.register(name, pa.Table.from_pylist([r.asDict() for r in df.collect()], schema=df.toArrow().schema))
    result = duck.execute(sql)
    columns = [c[0] for c in result.description]
    return columns, sorted(map(str, result.fetchall()))


def same_as_sql(df, sql, **tables):
    columns, want = by_sql(sql, **tables)
    assert sorted(columns) == sorted(df.columns)
    return sorted(str(tuple(r)) for r in df.select(columns).collect()) == want


# --- source audit -------------------------------------------------------------------------------

AUDITED = "doc_id long, text string, lang string, source string, term string, n long, rank int, value string"


def audited(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, "x", 7, None, None) for i, (t, lang, s) in enumerate(rows)], AUDITED)


def untidy_sources():
    rng = random.Random(11)
    words = [f"w{a}" for a in "abcdefghijklmnopqrstuvwxyz"] + ["É", "é", "日本", "ÀB", "a_b", "x-1"]
    rows = []
    for _ in range(160):
        lang, source = rng.choice(["en", "en", "en", "de", "", None]), rng.choice(["s0", "s0", "s1", "s2", "é", "", None])
        text = rng.choice(words[:8]).join(rng.choices([" ", ".", "\n", "1"], k=rng.randint(0, 9)))
        rows.append((text + " " + " ".join(rng.choices(words, k=rng.randint(0, 30))).title(), lang, source))
    rows += [("", "en", "none"), (None, "en", "null"), ("1 2 3", "en", "digits"), ("rare one", "xx", "a"), ("alone", "xx", "b")]
    rows += [("same words here", "fr", "s0")] * 3 + [("same words here", "fr", "s1")] * 3
    rows.append(("wa wb " * 40_000, "de", "s1"))
    return rows


def test_audit_equals_the_dense_definition(spark, monkeypatch):
    monkeypatch.setattr(source_divergence, "HELD_TERMS", 40)  # many partial sums
    docs = audited(spark, untidy_sources()).repartition(3)
    got = source_divergence.divergence_audit(docs)
    assert same_as_sql(got, OP11_SQL, documents=docs)
    parts = {(r["lang"], r["part"]) for r in got.select("lang", "part").collect()}
    assert ("xx", "pair") in parts and ("xx", "term") not in parts
    pairs = got.filter("part = 'pair' AND lang IN ('xx', 'fr')")
    assert {r["value"] for r in pairs.collect()} == {0}


def test_audit_of_an_empty_table(spark):
    assert source_divergence.divergence_audit(audited(spark, [])).count() == 0


def test_audit_ranks_ties_by_bytes_and_stops_at_the_bound(spark):
    rows = [(" ".join(f"t{chr(0x61 + i)}" for i in range(9)), "en", "s")] * 3 + [("other", "en", "o")] * 3
    got = source_divergence.divergence_audit(audited(spark, rows), top_terms=4).filter("part = 'term' AND source = 's'")
    assert [r["item"] for r in got.orderBy("rank").collect()] == ["ta", "tb", "tc", "td"]


def test_audit_keeps_the_vocabulary_and_counts_of_count_vectorizer(spark):
    docs = audited(spark, untidy_sources())
    split = docs.fillna("").withColumn("tokens", F.expr(
        r"filter(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
        r" '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+', 0), t -> true)"))
    kept = defaultdict(int)
    for r in source_divergence.kept_terms(docs).collect():
        kept[r["lang"], r["term"]] += r["n"]
    for lang in ("en", "de", ""):
        mine = split.filter(F.col("lang") == lang)
        model = CountVectorizer(inputCol="tokens", outputCol="v", minDF=3, vocabSize=2**31 - 1).fit(mine)
        sums = Counter()
        for r in model.transform(mine).select("v").collect():
            sums.update({model.vocabulary[i]: int(x) for i, x in zip(r["v"].indices, r["v"].values, strict=True)})
        assert {t: n for (of, t), n in kept.items() if of == lang} == sums and sums


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = "Ab é" * 50 + " x" * 30 + "日本" * 40
    whole = source_divergence.document_vector(text.encode())
    monkeypatch.setattr(source_divergence, "CHUNK", 7)
    assert source_divergence.document_vector(text.encode()) == whole
    assert {t.decode(): n for t, n in whole.items()} == Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.replace("A", "a")))


def test_share_is_exact_beyond_what_a_product_holds(spark):
    cases = [(0, 0, 1), (10**15, 3 * 10**15, 7), (9 * 10**12, 9 * 10**12 + 1, 10**6), (5, 5, 1), (2, 10**15, 3)]
    df = spark.createDataFrame(cases, "n long, total long, size long")
    got = df.select("*", source_divergence.share(F.col("n"), F.col("total"), F.col("size")).alias("p")).collect()
    assert all(r["p"] == 1 + 10**9 * (r["n"] + 1) // (r["total"] + r["size"]) for r in got)


def test_audit_joins_on_terms_without_cartesian_or_python_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    text = source_divergence.divergence_audit(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Cartesian|NestedLoop|Arrow", text)


# --- spelling variants --------------------------------------------------------------------------


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows):
    counts = Counter()
    for doc_id, text in rows:
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def variant_rows():
    rng = random.Random(12)
    bases = ["".join(rng.choices("abcé", k=rng.randint(6, 9))) for _ in range(25)] + ["aaaaaa", "aaaaaaa", "aaaaaaaa", "ÀÉïöüß", "straße×÷ab"]
    words = []
    for base in bases:
        words += [base] * 150
        for _ in range(6):
            at = rng.randrange(len(base) + 1)
            near = rng.choice([base[:at] + "d" + base[at:], base[:at] + base[at + 1 :], base[:at] + "c" + base[at + 1 :]])
            words += [near] * rng.choice([3, 5, 6, 30, 150])
            words += [near[: at // 2] + "f" + near[at // 2 :]] * rng.choice([5, 6])
    rng.shuffle(words)
    words = [w.upper() if rng.random() < 0.1 and w.isascii() else w for w in words]
    rows = [(i % 50, " -1\n"[i % 4].join(words[i : i + 9])) for i in range(0, len(words), 9)]
    long = "z" * 3_000
    rows += [(90 + i, f"{long} {long}q {long[:-1]}y") for i in range(6)]
    return [*rows, (None, "nullid " * 30 + "nulliid " * 5), (None, None), (3, ""), (3, "short word"), (7, "x" * 5), (7, "x" * 5)]


@pytest.mark.parametrize("group_words", [3, 100_000])
def test_variants_by_definition(spark, monkeypatch, group_words):
    if group_words == 3:
        for name, size in (("HELD_WORDS", 7), ("BATCH_ROWS", 5)):
            monkeypatch.setattr(spelling_variants, name, size)
    rows = variant_rows()
    docs = spark.createDataFrame(
        [(i, t, "w", 1, "k", "r") for i, t in rows], "doc_id long, text string, word string, n long, key string, root string"
    ).repartition(3)
    got = spelling_variants.group_variants(docs, group_words=group_words).collect()
    want = brute_variants(rows)
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got} == want
    assert len(got) == len(want) > 100
    assert any(f and r != f for f, r, *_ in want.values()), "no chain of forms in the fixture"


def test_variant_sql_states_the_definition(spark):
    rows = [(i, t) for i, t in variant_rows() if i is None or i < 60]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    columns, got = by_sql(OP12_SQL, documents=docs)
    place = [columns.index(c) for c in ("word", "form", "root", "n", "n_near", "form_n")]
    want = [(w, *rest) for w, rest in brute_variants(rows).items()]
    assert got == sorted(str(tuple(row[place.index(i)] for i in range(6))) for row in want)


def test_variants_of_an_empty_table(spark):
    for rows in ([], [(1, None), (2, "few words only")]):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        assert spelling_variants.group_variants(docs).count() == 0


def test_scan_of_a_sorted_list_finds_every_pair_at_one_edit():
    rng = random.Random(2)
    for _ in range(500):
        parts = sorted({"".join(rng.choices("abc", k=rng.randint(0, 7))) for _ in range(rng.randint(1, 40))})
        want = [(i, j) for i in range(len(parts)) for j in range(i + 1, len(parts)) if one_edit(parts[i], parts[j])]
        assert sorted(spelling_variants.near_in_list(parts)) == want


def test_scan_passes_over_ranges_that_share_a_far_prefix():
    """A list of two halves: the work on words of the other half ends in their shared prefix."""
    touched = Counter()

    class Counted(str):
        def __getitem__(self, at):
            touched["chars"] += isinstance(at, int)
            return super().__getitem__(at)

    tails = ["".join(p) for p in __import__("itertools").product("abcd", repeat=4)]
    parts = sorted([Counted("qqqq" + t) for t in tails] + [Counted("zzzz" + t) for t in tails])
    list(spelling_variants.near_in_list(parts))
    assert touched["chars"] < len(parts) ** 2 / 2


def test_groups_stay_bounded_when_a_third_of_all_words_share_their_first_half(spark):
    rng = random.Random(3)
    hot = {"common" + "".join(rng.choices("abcdefgh", k=6)) for _ in range(400)}
    rest = {"".join(rng.choices("abcdefghijklmnop", k=12)) for _ in range(800)}
    words = spark.createDataFrame([(w, 9) for w in hot | rest], "word string, n long")
    groups = spelling_variants.meeting_groups(words, 40)
    largest = groups.groupBy("key").count().agg(F.max("count")).first()[0]
    assert largest <= 40


# --- chat formatting ----------------------------------------------------------------------------

CHATS = "conv_id long, turn long, role string, text string, rows string, block long, formatted string"
MARKS = ["<s>", "</s>", "[INST]", "[/INST]"]


def chats(spark, rows):
    return spark.createDataFrame([(*r, "x", 5, "y") for r in rows], CHATS)


def untidy_chats():
    rng = random.Random(13)
    bits = [*MARKS, *(m[0] + "\\" * k + m[1:] for m in MARKS for k in (1, 2, 3)), "<", "[", "\\", "\n", "é", "日", "$1", " ok ", "/s>", "INST]"]
    rows = []
    for conv in range(40):
        for turn in range(rng.randint(1, 7)):
            role = rng.choice(["user", "assistant", "assistant", "system", "tool", "<s>[INST]", "", None])
            text = rng.choice([None, "", "".join(rng.choices(bits, k=rng.randint(1, 12)))])
            rows.append((conv, rng.choice([turn, turn, None, 3]), role, text))
    rows += rows[:9]  # repeated rows
    rows += [(None, 0, "user", "a"), (None, 1, "assistant", "b<s>"), (None, None, None, None)]
    rows += [(77, i, "assistant" if i % 3 else "user", f"m{i} " + rng.choice(bits)) for i in range(300)]
    return rows + [(78, 0, "assistant", "long </s>" * 20_000), (79, 0, "user", "\\" * 30_000 + "<" * 30_000)]


def brute_chats(rows):
    by_conv = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conv[conv].append((turn is not None, turn or 0, role or "", text or ""))
    found = {}
    for conv, messages in by_conv.items():
        messages.sort()
        turns = "".join(f"{role}\n{text}\n" for *_, role, text in messages)
        loss = "".join(text for *_, role, text in messages if role == "assistant")
        found[conv] = (
            len(messages), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()
        )
    return found


def digests(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in df.collect()}


@pytest.mark.parametrize(("segment_rows", "segment_chars"), [(1_000, 1 << 20), (4, 1 << 20), (50, 30), (1, 0)])
def test_chats_read_back_as_they_were(spark, segment_rows, segment_chars):
    rows = untidy_chats()
    formatted = chat_format.format_chats(chats(spark, rows).repartition(5), chat_format.DEFAULT, segment_rows, segment_chars)
    back = chat_format.read_back(formatted)
    assert digests(back) == brute_chats(rows) and back.count() == len(brute_chats(rows))
    length = {r["conv_id"]: r["formatted_chars"] for r in back.collect()}
    for r in formatted.groupBy("conv_id").agg(F.sum(F.length("formatted")).alias("n")).collect():
        assert length[r["conv_id"]] == r["n"]


@pytest.mark.parametrize(("segment_rows", "segment_chars"), [(4, 1 << 20), (50, 30), (1, 0)])
def test_segments_joined_are_the_same_text_wherever_they_are_cut(spark, segment_rows, segment_chars):
    df = chats(spark, untidy_chats())

    def texts(*limits):
        found = defaultdict(list)
        for r in chat_format.format_chats(df, chat_format.DEFAULT, *limits).collect():
            found[r["conv_id"]].append((r["block"], r["part"], r["formatted"]))
        return {conv: "".join(text for *_, text in sorted(parts)) for conv, parts in found.items()}

    assert texts(segment_rows, segment_chars) == texts(1 << 30, 1 << 40)
    cut = chat_format.read_back(chat_format.format_chats(df, chat_format.DEFAULT, segment_rows, segment_chars))
    whole = chat_format.read_back(chat_format.format_chats(df, chat_format.DEFAULT, 1 << 30, 1 << 40))
    assert sorted(map(str, cut.collect())) == sorted(map(str, whole.collect()))


def test_chat_sql_states_the_definition(spark):
    rows = untidy_chats()
    marked = [(-7, i, role, chat_format.MARKED[2]) for i, role in enumerate(("user", "assistant"))]
    df = chat_format.read_back(chat_format.format_chats(chats(spark, [*rows, *marked])))
    assert same_as_sql(df, OP13_SQL, conversations=chats(spark, rows).select("conv_id", "turn", "role", "text"))


def test_neighbours_of_one_role_are_one_turn(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "</s>x"), (1, 3, "assistant", ""), (1, 4, "user", "c")]
    (r,) = chat_format.format_chats(chats(spark, rows)).collect()
    assert r["formatted"] == (
        "<s>user[INST]a[/INST][INST]b[/INST]</s><s>assistant[INST]<\\/s>x[/INST][INST][/INST]</s><s>user[INST]c[/INST]</s>"
    )
    assert [r["formatted"][s["start"] : s["end"]] for s in r["loss_spans"]] == ["<\\/s>x", ""]


def test_no_mark_is_left_in_an_escaped_text_and_no_text_is_lost(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choices("<[/\\sINT>]", k=rng.randint(0, 14))) for _ in range(3_000)] + MARKS
    texts += [m[0] + "\\" * k + m[1:] for m in MARKS for k in range(4)]
    template = chat_format.DEFAULT
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", template.escape(F.col("t")))
    for r in df.withColumn("u", template.unescape(F.col("e"))).collect():
        assert r["u"] == r["t"] and not any(m in r["e"] for m in MARKS)
    with pytest.raises(ValueError):
        chat_format.Template(turn="<<s>")


def test_segments_of_a_large_conversation_are_bounded_and_cut_between_tasks(spark):
    rows = [(1, i, "user", "x" * 50) for i in range(600)] + [(i, 0, "user", "y") for i in range(2, 300)]
    merged = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merged, "false")
    try:
        formatted = chat_format.format_chats(chats(spark, rows), segment_rows=100, segment_chars=1_000)
        shown = formatted.filter("conv_id = 1").select(F.length("formatted").alias("n"), F.spark_partition_id().alias("p"))
        large = shown.collect()
    finally:
        spark.conf.set(merged, "true")
    assert len(large) == 30 and max(r["n"] for r in large) < 2_500 and len({r["p"] for r in large}) > 1


def test_chats_of_an_empty_table(spark):
    formatted = chat_format.format_chats(chats(spark, []))
    assert formatted.count() == 0 and chat_format.read_back(formatted).count() == 0


def test_formatting_needs_no_python(spark):
    formatted = chat_format.format_chats(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))
    assert not re.search("Python|Arrow|Pandas|Cartesian", formatted._jdf.queryExecution().executedPlan().toString())
