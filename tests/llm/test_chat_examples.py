"""op13 reads every example written out, not the spans it could be written from."""

from pyspark.sql import functions as F

from tallyloom.llm import chat_format as cf

SCHEMA = "conv_id long, turn long, role string, text string"
ROWS = [(1, 0, "user", "a"), (1, 1, "assistant", "b </s>"), (1, 2, "user", "c"), (1, 3, "assistant", "é"), (2, 0, "user", "no reply"), (None, 0, "assistant", "x")]


def test_digests_are_those_of_the_examples_written_out(spark, monkeypatch):
    chat = cf.format_chats(spark.createDataFrame(ROWS, SCHEMA))
    spelled = cf.example_texts
    texts = {}
    for r in spelled(chat).collect():
        texts.setdefault(r["conv_id"], []).append(r["text"])
    found = {r["conv_id"]: r for r in cf.chat_digests(chat).collect()}
    for conv in (1, 2, None):
        assert (found[conv]["n_examples"], found[conv]["example_chars"]) == (len(texts.get(conv, [])), sum(len(t) - 4 for t in texts.get(conv, [])))
    monkeypatch.setattr(cf, "example_texts", lambda c: spelled(c).withColumn("text", F.concat("text", F.lit("!!"))))
    longer = {r["conv_id"]: r["example_chars"] for r in cf.chat_digests(chat).collect()}
    assert longer == {conv: found[conv]["example_chars"] + 2 * found[conv]["n_examples"] for conv in found}
