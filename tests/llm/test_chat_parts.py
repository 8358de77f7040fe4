import hashlib

from pyspark.sql import functions as F

from matchspark.llm.chat_parts import PART, escape, format_chat, read_loss, read_turns, unescape

SCHEMA = f"conv_id long, turn long, role string, parts array<{PART}>, formatted string"


def text(t):
    return ("text", t, None, None, None, None, None)


def test_escape_is_reversible_and_hides_control_strings(spark):
    nasty = ["", "<|", "<\\|", "<\\\\|x<|", "a<b|c", "<|im_end|>\n<|part|>", "<", "|", "\\<|\\"]
    df = spark.createDataFrame([(t,) for t in nasty], "t string")
    for t, e, back in df.select("t", escape(F.col("t")), unescape(escape(F.col("t")))).collect():
        assert back == t and "<|" not in e


def test_parts_are_ordered_recorded_and_read_back(spark):
    turns = [
        (1, 2, "assistant", [text("an<"), text("|swer<|im_end|>")], "clash"),
        (1, 1, "user", [text("see "), ("image", None, "i.png", 28, 29, None, None), ("audio", None, "a.wav", None, None, 1.01, None), text("")], "x"),
        (1, 1, "user", [("document", None, "d.pdf", None, None, None, 3), ("odd", None, "o", None, None, None, None)], "x"),
        (1, None, "ro\\nle\n<|", None, None),
        (None, 1, None, [text(None)], None),
        (2, 1, "assistant", [text("long" * 100_000)], None),
    ]
    got = {r.conv_id: r for r in format_chat(spark.createDataFrame(turns, SCHEMA)).withColumn("read", read_turns(F.col("formatted"))).withColumn("loss", read_loss(F.col("formatted"), F.col("loss_spans"))).collect()}
    assert set(got) == {None, 1, 2}
    one = got[1]
    assert [(t.role, t.parts) for t in one.read] == [
        ("ro\\nle\n<|", [""]),
        ("user", ["<|document|>", "<|document|>"]),
        ("user", ["see ", "<|image|>", "<|audio|>", ""]),
        ("assistant", ["an<", "|swer<|im_end|>"]),
    ]
    assert [(a.ordinal, a.type, a.ref, a.turn, a.tokens) for a in one.attachments] == [
        (0, "document", "d.pdf", 1, 768), (1, "document", "o", 1, 256), (2, "image", "i.png", 2, 6), (3, "audio", "a.wav", 2, 26),
    ]
    assert one.expanded == 768 + 256 + 6 + 26
    assert one.loss == "an<|swer<|im_end|>"
    assert got[None].formatted == "<|im_start|>\n<|im_end|>\n"
    assert hashlib.sha256(got[2].loss.encode()).hexdigest() == hashlib.sha256(b"long" * 100_000).hexdigest()
    for r in got.values():
        for s in r.loss_spans:
            assert r.formatted[s.start + s.length :].startswith("<|im_end|>\n")


def test_empty_table(spark):
    assert format_chat(spark.createDataFrame([], SCHEMA)).count() == 0
