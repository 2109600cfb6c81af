import hashlib

from pyspark.sql import functions as F

from siltstone.llm import chat_format as chat

ROWS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "### x: </turn>\n<|image|> \\ \\\\ ####### <\\/turn>"),
    (1, 2, "assistant", "a\\"), (1, 3, "assistant", None), (1, 4, "user", ""), (1, 5, "assistant", "é😀</turn>"),
    (2, None, None, "no role or turn"), (2, 1, "assistant", "tie b"), (2, 1, "assistant", "tie a"),
    (2, 1, "assistant", "tie a"), (None, 0, "odd: role ###\n", "\\### Assistant: </turn> ok"), (3, 0, "user", None),
]
SCHEMA = "conv_id long, turn long, role string, text string"


def expected(rows):
    talks = {}
    for c, t, r, x in rows:
        talks.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    out = {}
    for c, turns in talks.items():
        turns.sort(key=lambda t: (t[0], t[1], t[2]))
        loss = "".join(x for _, r, x in turns if r == "assistant")
        joined = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        out[c] = (
            len(turns), hashlib.sha256(joined.encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
        )
    return out


def test_round_trip_of_odd_texts(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumn("formatted", F.lit(1)).withColumn("c", F.lit(2))
    got = chat.digests(chat.format_chat(df)).collect()
    assert {r[0]: tuple(r[1:5]) for r in got} == expected(ROWS)


def test_very_long_text_and_many_turns(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], "\\<## " * 2000) for i in range(60)]
    rows.append((2, 0, "assistant", "x </turn>" * 200_000))
    got = chat.digests(chat.format_chat(spark.createDataFrame(rows, SCHEMA))).collect()
    assert {r[0]: tuple(r[1:5]) for r in got} == expected(rows)


def test_empty_table(spark):
    assert chat.digests(chat.format_chat(spark.createDataFrame([], SCHEMA))).count() == 0


def test_control_strings_only_where_the_template_has_them(spark):
    row = chat.format_chat(spark.createDataFrame(ROWS, SCHEMA).where("conv_id = 1")).first()
    assert row["formatted"].count("</turn>") == 6
    assert row["formatted"].count("###") == 6
    assert row["formatted"].count("<|") == 0


def test_typed_parts(spark):
    rows = [
        (1, 0, "user", [
            ("text", "see <|image|> ", None, None, None, None, None),
            ("image", None, "a.png", 28, 15, None, None),
            ("text", " and ", None, None, None, None, None),
            ("audio", None, "b.wav", None, None, 1.5, None),
        ]),
        (1, 1, "assistant", [("text", "ok", None, None, None, None, None), None]),
        (1, 2, "user", [("document", None, "c.pdf", None, None, None, 3), ("image", None, None, None, None, None, None)]),
        (1, 3, "user", None), (1, 4, "user", []), (1, 5, "user", [(None, "plain", None, None, None, None, None)]),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    formatted = chat.format_chat(df, parts=F.col("parts"))
    row = chat.read_back(formatted).first()
    assert [(a["turn"], a["kind"], a["ref"], a["tokens"]) for a in row["attachments"]] == [
        (0, "image", "a.png", 4), (0, "audio", "b.wav", 38), (2, "document", "c.pdf", 1536), (2, "image", None, 0),
    ]
    assert row["attachment_tokens"] == 4 + 38 + 1536
    import re

    marks = re.findall(r"<\|(\w+)\|>", row["formatted"])
    assert marks == [a["kind"] for a in row["attachments"]]
    assert [t["content"] for t in row["turns"]][1] == "ok" and row["loss_texts"] == ["ok"]
    assert [t["content"] for t in row["turns"]][3:] == ["", "", "plain"]
