"""Chat formatting with typed content parts, in DataFrame functions only.

A turn is a list of parts. Text parts become escaped text; image, audio and
document parts become placeholders. The k-th placeholder of a formatted
conversation belongs to the k-th entry of its ``attachments``, which holds the
reference and the number of tokens that the placeholder expands to.

A turn is written as ``### role: content</turn>\\n``. In texts and roles ``\\``
becomes ``\\\\``, ``##`` becomes ``#\\#``, ``</turn>`` becomes ``<\\/turn>`` and
``<|`` becomes ``<\\|``, so that no control string is left; a backslash is taken
off the character after it to read the text back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADER, SEPARATOR, FOOTER = "### ", ": ", "</turn>\n"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
PART = (
    "struct<kind:string,text:string,ref:string,width:bigint,height:bigint,"
    "seconds:double,pages:bigint>"
)


def escape(text: Column) -> Column:
    for plain, safe in (("\\", "\\\\"), ("##", "#\\#"), ("</turn>", "<\\/turn>"), ("<|", "<\\|")):
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(SEPARATOR), F.lit(":\\ "))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_part(text: Column) -> Column:
    """One text part, for tables whose turns are plain text."""
    none = {"ref": "string", "width": "bigint", "height": "bigint", "seconds": "double", "pages": "bigint"}
    return F.struct(
        F.lit("text").alias("kind"), text.alias("text"),
        *[F.lit(None).cast(kind).alias(name) for name, kind in none.items()],
    )


def flatten_part(part: Column) -> Column:
    """What a part puts into the formatted text; unknown kinds put their text."""
    kinds = F.lit(None).cast("string")
    for kind, placeholder in PLACEHOLDERS.items():
        kinds = F.coalesce(F.when(part["kind"] == kind, F.lit(placeholder)), kinds)
    return F.coalesce(kinds, escape(part["text"]), F.lit(""))


def expanded_tokens(part: Column, patch: int, audio_rate: float, page_tokens: int) -> Column:
    """Tokens of an attachment: patches, audio frames, or pages; unknown sizes give 0."""
    tiles = F.ceil(part["width"] / patch) * F.ceil(part["height"] / patch)
    return F.coalesce(
        F.when(part["kind"] == "image", tiles)
        .when(part["kind"] == "audio", F.ceil(part["seconds"] * audio_rate))
        .when(part["kind"] == "document", part["pages"] * page_tokens),
        F.lit(0),
    ).cast("bigint")


def format_chat(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    parts: Column | None = None,
    loss_roles: tuple[str, ...] = ("assistant",),
    patch: int = 14,
    audio_rate: float = 25.0,
    page_tokens: int = 512,
) -> DataFrame:
    """One row per conversation with its formatted text, loss mask and attachments.

    ``parts`` is an array of ``PART`` structs; without it the column ``text`` is
    one text part. Columns: the conversation id, ``formatted``, ``loss_mask`` (per
    turn: characters before the content within the turn, characters of the
    content, and if it is trained on), ``attachments`` (turn number from 0, kind,
    ref, tokens) and ``attachment_tokens``.

    Turns go by ``turn``, null first; equal ones by role, then content. Repeated
    rows are turns of their own. A null role or text is empty, null or empty parts
    are an empty turn, rows of a null conversation are one conversation. Other
    columns are not read. A conversation is one string, so it must fit into one
    row (2 GB); the turns of one conversation meet in one task for that.
    """
    content = F.coalesce(
        parts if parts is not None else F.array(text_part(F.col("text"))),
        F.array().cast(f"array<{PART}>"),
    )
    rows = turns.select(
        F.col(conversation).alias("c"), F.col(turn).alias("t"),
        F.coalesce(F.col(role), F.lit("")).alias("r"),
        F.filter(content, lambda p: p.isNotNull()).alias("p"),
    )
    flat = rows.select(
        "c", "t", "r",
        F.array_join(F.transform("p", flatten_part), "").alias("body"),
        F.transform(
            F.filter("p", lambda p: p["kind"].isin(*PLACEHOLDERS)),
            lambda p: F.struct(
                p["kind"].alias("kind"), p["ref"].alias("ref"),
                expanded_tokens(p, patch, audio_rate, page_tokens).alias("tokens"),
            ),
        ).alias("a"),
    ).withColumn("head", F.concat(F.lit(HEADER), escape_role(F.col("r")), F.lit(SEPARATOR)))
    whole = flat.groupBy("c").agg(
        F.array_sort(F.collect_list(F.struct("t", "r", "body", "a", "head"))).alias("s")
    )
    # array_sort puts null turns first, as structs compare null as smallest.
    mask = F.transform(
        "s",
        lambda x: F.struct(
            F.char_length(x["head"]).cast("bigint").alias("before"),
            F.char_length(x["body"]).cast("bigint").alias("length"),
            x["r"].isin(*loss_roles).alias("loss"),
        ),
    )
    attached = F.flatten(
        F.transform(
            "s",
            lambda x, i: F.transform(
                x["a"],
                lambda y: F.struct(
                    i.alias("turn"), y["kind"].alias("kind"), y["ref"].alias("ref"),
                    y["tokens"].alias("tokens"),
                ),
            ),
        )
    )
    return whole.select(
        F.col("c").alias(conversation),
        F.array_join(
            F.transform("s", lambda x: F.concat(x["head"], x["body"], F.lit(FOOTER))), ""
        ).alias("formatted"),
        mask.alias("loss_mask"),
        attached.alias("attachments"),
    ).withColumn(
        "attachment_tokens",
        F.aggregate("attachments", F.lit(0).cast("bigint"), lambda n, a: n + a["tokens"]),
    )


def split_turns(formatted: Column) -> Column:
    """The raw turns of a formatted conversation, headers included."""
    cut = F.split(formatted, FOOTER)
    return F.slice(cut, 1, F.size(cut) - 1)


def turn_role(raw: Column) -> Column:
    end = F.locate(SEPARATOR, raw)
    return unescape(F.substring(raw, F.lit(len(HEADER) + 1), end - len(HEADER) - 1))


def turn_content(raw: Column) -> Column:
    """The content of a raw turn, placeholders kept, texts unescaped."""
    start = F.locate(SEPARATOR, raw) + len(SEPARATOR)
    return unescape(F.substring(raw, start, F.length(raw)))


def read_back(formatted: DataFrame, text: str = "formatted", mask: str = "loss_mask") -> DataFrame:
    """Adds ``turns`` (role, content) and ``loss_texts``, both read from the output alone."""
    return formatted.withColumn("__raw", split_turns(F.col(text))).withColumns(
        {
            "turns": F.transform(
                "__raw",
                lambda r: F.struct(turn_role(r).alias("role"), turn_content(r).alias("content")),
            ),
            "loss_texts": F.transform(
                F.filter(F.arrays_zip("__raw", mask), lambda z: z[mask]["loss"]),
                lambda z: unescape(
                    F.substring(
                        z["__raw"], (z[mask]["before"] + 1).cast("int"), z[mask]["length"].cast("int")
                    )
                ),
            ),
        }
    ).drop("__raw")


def digests(formatted: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """Digest columns of each conversation, from what ``read_back`` finds."""
    back = read_back(formatted)
    turns_text = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["content"], F.lit("\n"))), ""
    )
    loss = F.array_join("loss_texts", "")
    return back.select(
        conversation,
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(turns_text, 256).alias("turns_sha256"),
        F.char_length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
        F.size("attachments").cast("bigint").alias("n_attachments"),
        "attachment_tokens",
    )
