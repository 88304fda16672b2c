r"""Chat formatting by prefix-target expansion, in DataFrame expressions only.

Every assistant turn becomes an example of its own: all turns before it are context, and only that reply is
trainable. Copied out, the examples of a conversation of n turns hold n * n / 2 turns, so they are stored
with shared prefixes: ``turns`` holds every formatted turn once, in order, and ``examples`` names for each
reply the first turn of its conversation and its own, and which characters of the text between bear loss.
``example_texts`` spells examples out, and ``chat_digests`` reads them so: one example is a row at a time, never stored.

Turns are ordered by range partitions of (conversation, turn), so a conversation of any length is spread.
Running sums are taken within a range; a conversation that goes on in the next range gets what came
before as an offset, one row per range at most.

The template: ``[SYS]text[/SYS]``, ``[INST]text[/INST]`` for a user, ``text</s>`` for an assistant, and
``[ROLE=hex]text[/ROLE]`` for any other role, whose name is in hex. A control string inside a text gets a
backslash after its first bracket (``[\INST]``, ``</\s>``), and one more if it has some there already, so
taking one away gives the text back.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.runtime import materialise

ASSISTANT = "assistant"
MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), ASSISTANT: ("", "</s>")}
OTHER = ("[ROLE=", "]", "[/ROLE]")

_OPEN, _REST = r"(</?|\[/?)", r"(s>|INST\]|SYS\]|ROLE[\]=])"
CONTROL = rf"{_OPEN}(\\*){_REST}"
ESCAPED = rf"{_OPEN}\\(\\*){_REST}"
#: One formatted turn; texts hold no control string, so the nearest end is the turn's own.
TURN = r"(?s)\[SYS\].*?\[/SYS\]|\[INST\].*?\[/INST\]|\[ROLE=[0-9A-F]*\].*?\[/ROLE\]|.*?</s>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _by_role(role: Column, make, other: Column) -> Column:
    return reduce(lambda rest, r: F.when(role == r, make(*MARKS[r])).otherwise(rest), MARKS, other)


def formatted(role: Column, text: Column) -> Column:
    """One turn by the template."""
    name, body = F.hex(F.encode(role, "UTF-8")), escape(text)
    other = F.concat(F.lit(OTHER[0]), name, F.lit(OTHER[1]), body, F.lit(OTHER[2]))
    return _by_role(role, lambda a, b: F.concat(F.lit(a), body, F.lit(b)), other)


def read_turn(turn: Column) -> Column:
    """(role, text) of one formatted turn."""

    def inner(begin: str, end: str) -> Column:
        return unescape(F.substring(turn, F.lit(len(begin) + 1), F.length(turn) - (len(begin) + len(end))))

    named = F.regexp_extract(turn, r"^\[ROLE=([0-9A-F]*)\]", 1)
    begin = F.length(named) + (len(OTHER[0]) + len(OTHER[1]))
    rest = F.substring(turn, begin + 1, F.length(turn) - begin - len(OTHER[2]))
    read = lambda role, text: F.struct(role.alias("role"), text.alias("text"))
    out = read(F.lit(ASSISTANT), inner(*MARKS[ASSISTANT]))
    out = F.when(turn.startswith(OTHER[0]), read(F.decode(F.unhex(named), "UTF-8"), unescape(rest))).otherwise(out)
    for role in ("user", "system"):
        out = F.when(turn.startswith(MARKS[role][0]), read(F.lit(role), inner(*MARKS[role]))).otherwise(out)
    return out


def read_turns(text: Column) -> Column:
    """Array of (role, text) of a formatted conversation."""
    return F.transform(F.regexp_extract_all(text, F.lit(TURN), F.lit(0)), read_turn)


class Chat(NamedTuple):
    """``turns(conv_id, piece, formatted)``, pieces in order; ``examples(conv_id, example, first_piece, target_piece,
    context_turns, loss_start, loss_end)``, code points of the text from the first to the target piece, end exclusive."""

    turns: DataFrame
    examples: DataFrame


def format_chats(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Chat:
    """Format the turns in ``rows`` and expand every assistant turn into an example; both tables are stored.

    Turns are in order of ``turn``, null first, equal ones by role and text. Rows with a null id are one
    conversation. A null text is empty, a null role is a role without name; an empty reply is an example with
    no trainable character. Repeated rows are turns of their own, and texts of any length are whole. Other
    columns are ignored. Without rows both tables are empty.
    """
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    rows = rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), by.alias("role"), said.alias("text"))
    ranged = rows.repartitionByRange("conv_id", "turn", "role", F.left("text", F.lit(64)))
    ordered = ranged.sortWithinPartitions("conv_id", "turn", "role", "text")
    pieces = ordered.select(
        "conv_id", F.monotonically_increasing_id().alias("piece"), formatted(F.col("role"), F.col("text")).alias("formatted"), (F.col("role") == ASSISTANT).alias("reply")
    )
    stored = materialise(pieces, "chat-turns")
    narrow = stored.select("conv_id", "piece", "reply", F.length("formatted").cast("long").alias("n"), F.shiftright("piece", 33).alias("part"))
    sums = [F.count("*").alias("turns"), F.sum("n").alias("chars"), F.count_if("reply").alias("replies"), F.min("piece").alias("first_piece")]
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = [F.sum(c).over(earlier).alias(f"{c}_before") for c in ("turns", "chars", "replies")]
    parts = narrow.groupBy("conv_id", "part").agg(*sums).select("conv_id", "part", *before, F.min("first_piece").over(earlier).alias("first_before"))
    going_on = F.broadcast(parts.where("turns_before > 0").withColumnsRenamed({"conv_id": "c", "part": "p"}))  # one row per range at most
    here = Window.partitionBy("conv_id", "part").orderBy("piece")
    so_far, ahead = here.rowsBetween(Window.unboundedPreceding, 0), here.rowsBetween(Window.unboundedPreceding, -1)
    running = narrow.select(
        "*", (F.row_number().over(here) - 1).alias("turns"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("chars"),
        (F.count_if("reply").over(so_far) - 1).alias("replies"), F.min("piece").over(so_far).alias("first_piece"),
    )
    placed = running.where("reply").join(going_on, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")), "left")
    total = lambda c: F.col(c) + F.coalesce(f"{c}_before", F.lit(0))
    examples = placed.select(
        "conv_id", total("replies").alias("example"), F.coalesce("first_before", "first_piece").alias("first_piece"), F.col("piece").alias("target_piece"),
        total("turns").alias("context_turns"), total("chars").alias("loss_start"), (total("chars") + F.col("n") - len(MARKS[ASSISTANT][1])).alias("loss_end"),
    )
    return Chat(stored.drop("reply"), materialise(examples, "chat-examples"))


def conversation_texts(chat: Chat) -> DataFrame:
    """(conv_id, text): every conversation's pieces in order, joined. A conversation is one cell."""
    pieces = F.sort_array(F.collect_list(F.struct("piece", "formatted")))
    return chat.turns.groupBy("conv_id").agg(F.array_join(F.transform(pieces, lambda p: p["formatted"]), "").alias("text"))


def example_texts(chat: Chat) -> DataFrame:
    """Examples with ``text``, from the first turn to the end of the reply. The whole grows with the square of a
    conversation's turns, so it is not stored; a conversation's text is shuffled once, whatever the number of its examples."""
    whole = conversation_texts(chat).withColumnRenamed("conv_id", "c")
    spelled = chat.examples.join(whole, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    return spelled.withColumn("text", F.substring("text", F.lit(1), (F.col("loss_end") + len(MARKS[ASSISTANT][1])).cast("int")))


def chat_digests(chat: Chat) -> DataFrame:
    """What the formatted chats say, per conversation: its turns read back from the joined pieces, and of all its examples,
    each spelled out, the characters up to the end of the reply and the text under the loss mask."""
    whole = conversation_texts(chat).withColumn("turns", read_turns(F.col("text")))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = whole.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), F.length("text").cast("long").alias("formatted_chars"))
    start, end = F.col("loss_start").cast("int"), F.col("loss_end").cast("int")
    masked = example_texts(chat).select("conv_id", "example", F.length("text").alias("chars"), unescape(F.substring("text", start + 1, end - start)).alias("mask"))
    replies = F.transform(F.sort_array(F.collect_list(F.struct("example", "mask"))), lambda e: e["mask"])
    shown = masked.groupBy(F.col("conv_id").alias("c")).agg(
        F.array_join(replies, "").alias("loss"), F.count("*").alias("examples"), F.sum(F.col("chars") - len(MARKS[ASSISTANT][1])).alias("chars")
    )
    none, loss = F.lit(0).cast("long"), F.coalesce("loss", F.lit(""))
    return read.join(shown, F.col("conv_id").eqNullSafe(F.col("c")), "left").select(
        "conv_id", "n_turns", "turns_sha256", F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars",
        F.coalesce("examples", none).alias("n_examples"), F.coalesce("chars", none).alias("example_chars"),
    )
