"""Small tables with everything that operators must stand."""

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = "score double, k long, id long, t string, __text string, `a.b` string"

SYLLABLES = {
    "en": "the ing ion ed er an re on at th ou sh wh ly est".split(),
    "de": "ung sch ein ver heit der ge be auf tz chen keit üb äu ß".split(),
    "fr": "eau oui que ment tion les ré è ç aux elle pour ch oi ê".split(),
}


def sentence(rng, lang, words):
    return " ".join(
        "".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(words)
    )


def documents(seed=1, rows=60, long_words=40_000):
    """Prose in three languages, exact and near copies, and odd rows."""
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        lang = rng.choice(list(SYLLABLES))
        out.append((i, sentence(rng, lang, rng.randint(8, 120)), lang, f"src{rng.choice([0, 0, 0, 1, 2])}", None))
    for i in range(rows, rows + 15):  # copies in another case
        base = rng.choice(out[:rows])
        out.append((i, base[1].upper() if i % 2 else base[1], base[2], base[3], 1))
    for i in range(rows + 15, rows + 40):  # near copies
        base = rng.choice(out[:rows])
        words = base[1].split(" ")
        words[rng.randrange(len(words))] = "changed"
        out.append((i, " ".join(words), base[2], base[3], 1))
    n = rows + 40
    odd = [
        (n, None, None, None, None), (n + 1, "", "en", "src0", 0), (n + 2, " \n\t ", "en", None, 4),
        (n + 3, "one two", "en", "src1", 7), (n + 4, "ONE  two", None, "src1", 8),
        (n + 5, "12 34 !!", "en", "src1", 8), (n + 6, sentence(rng, "en", long_words), "en", "src2", None),
        (None, "a row without an id and with some more words", "en", "src2", 1), (None, None, None, None, None),
        (n + 7, "É é Ünlü I i 漢字 😀 <|endoftext|> tail  spaces ", "fr", "src1", 3),
        (n + 7, "É é Ünlü I i 漢字 😀 <|endoftext|> tail  spaces ", "fr", "src1", 3),
    ]
    return out + odd + [out[3], out[3]]


def frame(spark, rows=None, extra=True):
    rows = documents() if rows is None else rows
    df = spark.createDataFrame(rows, DOCUMENTS).repartition(3)
    if extra:
        df = df.selectExpr(
            "*", "0.5D AS score", "1L AS k", "2L AS id", "'x' AS t", "'y' AS __text", "'z' AS `a.b`"
        )
    return df


def bag(rows):
    return sorted(map(repr, rows))
