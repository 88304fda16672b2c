"""Chat formatting against plain Python, control strings, and edge cases."""

import re
from hashlib import sha256

from tallyloom.llm import chat_format as cf

SCHEMA = "conv_id long, turn long, role string, text string, piece string, formatted int, c string"
NASTY = [
    "</s>[INST] ok [/INST]", r"[\INST] </\s> \[INST] [\\INST]", "[[INST]]]", "<</s>>", "</", "[", "\\", "[ROLE=41]x[/ROLE]", "[SYS][/SYS]", "<s></s>\n\n<s>", "$1 \\1 \\", "[/", "INST]",
    "s>", "", "é日本\U0001f600", r"<\\s>[/\\\SYS]", "<|im_start|>", "ROLE]", "[/ROLE][ROLE]",
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", 3, "q") for r in rows], SCHEMA).repartition(4)


def digest(text):
    return sha256(text.encode()).hexdigest()


def plain(rows):
    """conv_id -> (turns in order, replies in order)."""
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for *_, r, t in sorted(turns)] for c, turns in out.items()}


def check(chat, rows):
    found = {r["conv_id"]: r for r in cf.chat_digests(chat).collect()}
    wanted = plain(rows)
    assert set(found) == set(wanted)
    for conv, turns in wanted.items():
        replies = [t for r, t in turns if r == "assistant"]
        r = found[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), digest("".join(f"{a}\n{b}\n" for a, b in turns)))
        assert (r["loss_chars"], r["loss_sha256"]) == (sum(map(len, replies)), digest("".join(replies)))
        assert r["n_examples"] == len(replies) and r["formatted_chars"] >= sum(len(t) for _, t in turns)


def test_control_strings_come_back(spark):
    roles = ["user", "assistant", "system", "tool", "", None, "Assistant", "]x[/ROLE]"]
    rows = [(i, j, role, text) for i, text in enumerate(NASTY) for j, role in enumerate(roles)]
    rows += [(100, j, ("user", "assistant")[j % 2], a) for j, a in enumerate(NASTY + NASTY[::-1])]
    check(cf.format_chats(frame(spark, rows)), rows)


def test_escaped_texts_hold_no_control_string(spark):
    df = spark.createDataFrame([(t,) for t in NASTY], "t string").select("t", cf.escape(cf.F.col("t")).alias("e"))
    for r in df.select("t", "e", cf.unescape(cf.F.col("e")).alias("u")).collect():
        assert r["u"] == r["t"]
        assert not re.search(r"</?s>|\[/?INST\]|\[/?SYS\]|\[/?ROLE[\]=]", r["e"])


def test_examples_are_prefixes(spark):
    rows = [(1, 0, "system", "be [INST]"), (1, 1, "user", "a"), (1, 2, "assistant", "b </s>"), (1, 3, "assistant", ""), (1, 4, "user", "c"), (1, 5, "assistant", "d"), (1, 6, "user", "end"), (2, 0, "user", "no reply")]
    chat = cf.format_chats(frame(spark, rows))
    found = cf.example_texts(chat).orderBy("conv_id", "example").collect()
    assert [(r["example"], r["context_turns"]) for r in found] == [(0, 2), (1, 3), (2, 5)]
    start = r"[SYS]be [\INST][/SYS][INST]a[/INST]"
    assert [r["text"] for r in found] == [start + r"b </\s></s>", start + r"b </\s></s></s>", start + r"b </\s></s></s>[INST]c[/INST]d</s>"]
    assert [r["text"][r["loss_start"] : r["loss_end"]] for r in found] == [r"b </\s>", "", "d"]
    check(chat, rows)


def test_a_long_conversation_spans_ranges(spark):
    rows = [(i % 7, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(200)]
    rows += [(50, i, ("user", "assistant", "assistant")[i % 3], f"turn {i} " * (i % 9)) for i in range(3000)]
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        chat = cf.format_chats(frame(spark, rows))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    parts = chat.turns.where("conv_id = 50").selectExpr("shiftright(piece, 33) AS p").distinct().count()
    assert parts > 8
    check(chat, rows)
    text = {r["conv_id"]: r["text"] for r in cf.conversation_texts(chat).collect()}
    replies = plain(rows)
    for conv in (3, 50):
        spans = chat.examples.where(f"conv_id = {conv}").orderBy("example").collect()
        turns = replies[conv]
        assert [r["example"] for r in spans] == list(range(len(spans)))
        assert [r["context_turns"] for r in spans] == [i for i, (role, _) in enumerate(turns) if role == "assistant"]
        assert [text[conv][r["loss_start"] : r["loss_end"]] for r in spans] == [t for role, t in turns if role == "assistant"]
        assert len({r["first_piece"] for r in spans}) == 1


def test_null_long_repeated_and_empty(spark):
    long = "word </s> [INST]\n" * 60_000
    rows = [(None, 0, "user", "x"), (None, None, "assistant", "y"), (1, 0, "user", long), (1, 1, "assistant", long), (2, 0, "user", None), (2, 1, None, "z"), (2, 1, "assistant", None)]
    rows += [(3, 5, "user", "same"), (3, 5, "user", "same"), (3, 5, "assistant", "same"), (3, 5, "assistant", "same"), (4, None, None, None)]
    chat = cf.format_chats(frame(spark, rows))
    check(chat, rows)
    assert chat.turns.columns == ["conv_id", "piece", "formatted"]
    none = cf.format_chats(frame(spark, rows).limit(0))
    assert none.turns.collect() == none.examples.collect() == cf.chat_digests(none).collect() == cf.example_texts(none).collect() == []


def test_no_python_worker_and_one_range_shuffle_of_texts(spark):
    from tallyloom.llm.queries import QUERIES

    plan = QUERIES["op13_chat_format"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    for node in ("ArrowEvalPython", "BatchEvalPython", "MapInArrow", "MapInPandas", "FlatMapGroups"):
        assert node not in plan
