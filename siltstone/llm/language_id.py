"""Multilingual mixture inference.

Every language has a distribution over hashed letter trigrams. A text is taken to
be drawn from a mixture of languages; expectation-maximisation finds the
proportions, and a language joins the set only if it raises the penalised
likelihood. How likely the text is at all, compared with texts of its language and with
trigrams never seen, tells whether it is in any learned language.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from siltstone.llm.common import as_bytes, slices

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
UNDETERMINED = "und"
#: Characters of a text that are turned into trigrams at a time.
CHUNK = 1 << 20
#: The model is broadcast: languages x 65536 numbers of 8 bytes.
MAX_LANGUAGES = 256


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigram_counts(text: str) -> tuple[np.ndarray, np.ndarray, bool]:
    """Buckets of a text's trigrams, how often each occurs, and if it has a letter.

    Anything but letters parts words. The whole text is read, in chunks.
    """
    total = np.zeros(BUCKETS, np.int64)
    any_letter = False
    tail = np.array([32, 32], np.uint32)
    lowered = text.lower()
    for start in range(0, len(lowered) + 1, CHUNK):
        piece = lowered[start : start + CHUNK]
        codes = np.frombuffer(piece.encode("utf-32-le", "replace"), np.uint32)
        letter = _letters()[codes]
        any_letter = any_letter or bool(letter.any())
        codes = np.where(letter, codes, 32).astype(np.uint32)
        last = start + CHUNK > len(lowered)
        codes = np.concatenate([tail, codes, np.array([32], np.uint32) if last else codes[:0]])
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
        codes = codes[keep]
        if len(codes) > 2:
            mixed = codes[:-2] * np.uint32(2654435761) + codes[1:-1] * np.uint32(2246822519)
            mixed = (mixed ^ (mixed >> np.uint32(15))) + codes[2:] * np.uint32(3266489917)
            mixed = (mixed ^ (mixed >> np.uint32(13))) * np.uint32(668265263)
            total += np.bincount(mixed >> np.uint32(32 - BUCKET_BITS), minlength=BUCKETS)
        tail = codes[-2:] if len(codes) > 1 else tail
    found = np.flatnonzero(total)
    return found, total[found], any_letter


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    log_p: np.ndarray  # languages x buckets

    @cached_property
    def scale(self) -> tuple[np.ndarray, np.ndarray]:
        """Per language, the log likelihood of a trigram never seen, and the expected one of
        the language's own."""
        return self.log_p.min(axis=1), (np.exp(self.log_p) * self.log_p).sum(axis=1)

    def infer(self, text: str, penalty: float = 2.0, rounds: int = 30) -> dict[str, float]:
        """The languages of a text with their proportions, largest first: see ``judge``."""
        return self.judge(text, penalty, rounds)[0]

    def judge(self, text: str, penalty: float = 2.0, rounds: int = 30) -> tuple[dict[str, float], float]:
        """The languages of a text with their proportions, largest first, and its fit.

        The fit is 1 for texts as likely as the main language's own and 0 for those with
        no trigram of it. Empty, with fit 0, when the text has no letter or nothing was
        learned. Ties go to the language that sorts first.
        """
        buckets, counts, any_letter = trigram_counts(text)
        if not any_letter or not self.languages or not len(buckets):
            return {}, 0.0
        logs = self.log_p[:, buckets]
        chosen = [int(np.argmax(logs @ counts))]
        top = logs.max(axis=0)
        p = np.exp(logs - top)  # scaled per bucket; likelihood ratios stay
        n = counts.sum()
        weights = np.ones(1)
        best = float(counts @ np.log(p[chosen[0]] + 1e-300))
        price = penalty * math.log(n + 1)
        while len(chosen) < len(self.languages):
            mixed = weights @ p[chosen]
            slope = p @ (counts / np.maximum(mixed, 1e-300)) - n
            slope[chosen] = -np.inf
            # The likelihood is concave in the weights, so a language without a
            # positive slope cannot raise it.
            tries = []
            for extra in np.flatnonzero(slope > price):
                w, value = _proportions(p[[*chosen, extra]], counts, rounds)
                if value - best > price:
                    tries.append((value, -int(extra), w))
            if not tries:
                break
            best, extra, weights = max(tries, key=lambda t: t[:2])
            chosen.append(-extra)
        order = sorted(range(len(chosen)), key=lambda i: (-weights[i], self.languages[chosen[i]]))
        each = float(counts @ (np.log(weights @ p[chosen] + 1e-300) + top)) / n
        unseen, own = (values[chosen[order[0]]] for values in self.scale)
        fit = max(0.0, float((each - unseen) / (own - unseen))) if own > unseen else 1.0
        return {self.languages[chosen[i]]: float(weights[i]) for i in order}, fit


def _proportions(p: np.ndarray, counts: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """Mixture weights by expectation-maximisation, and the log likelihood."""
    w = np.full(len(p), 1 / len(p))
    n = counts.sum()
    for _ in range(rounds):
        new = w * (p @ (counts / np.maximum(w @ p, 1e-300))) / n
        done = np.abs(new - w).max() < 1e-4
        w = new
        if done:
            break
    return w, float(counts @ np.log(np.maximum(w @ p, 1e-300)))


def train(
    docs: DataFrame,
    allowed: Column,
    id_column: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample_per_language: int = 4000,
    smoothing: float = 0.05,
) -> LanguageModel:
    """Learn trigram distributions from labelled rows for which ``allowed`` holds.

    The classifier is fitted on a bounded sample: about ``sample_per_language``
    rows of each language, chosen by a hash of the id, all rows if there are fewer.
    Rows without language or text teach nothing; no rows give an empty model. Of more
    than ``MAX_LANGUAGES`` labels those with most rows are learned, of equal ones those
    that sort first.
    """
    rows = docs.select(
        F.col(id_column).alias("i"), F.col(text).alias("t"), F.col(lang).alias("l"),
        allowed.alias("a"),
    ).where("a AND l IS NOT NULL AND t IS NOT NULL")
    most = rows.groupBy("l").count().orderBy(F.desc("count"), "l").limit(MAX_LANGUAGES)
    sizes = {r["l"]: r["count"] for r in most.collect()}
    if not sizes:
        return LanguageModel((), np.zeros((0, BUCKETS)))
    languages = tuple(sorted(sizes))
    share = F.create_map(
        *[F.lit(x) for l in languages for x in (l, min(1.0, sample_per_language / sizes[l]))]
    )[F.col("l")]
    spread = F.pmod(F.xxhash64(F.coalesce("i", F.lit(-1))), F.lit(1 << 20)) / F.lit(float(1 << 20))
    counted = (
        rows.where(spread < share)
        .select("t", "l")
        .mapInArrow(_count_sample, "l string, bucket int, n long")
        .groupBy("l", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    counts = np.zeros((len(languages), BUCKETS))
    at = {l: i for i, l in enumerate(languages)}
    for row in counted.collect():
        counts[at[row["l"]], row["bucket"]] = row["n"]
    total = counts.sum(axis=1, keepdims=True)
    return LanguageModel(languages, np.log((counts + smoothing) / (total + smoothing * BUCKETS)))


def _count_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in slices(batches):
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            buckets, counts, _ = trigram_counts(text)
            totals.setdefault(lang, np.zeros(BUCKETS, np.int64))[buckets] += counts
    for lang, total in totals.items():
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.repeat(lang, len(found)), pa.array(found, pa.int32()), pa.array(total[found])],
            names=["l", "bucket", "n"],
        )


def identify(
    docs: DataFrame, model: LanguageModel, keep: list[Column], text: str = "text",
    penalty: float = 2.0,
) -> DataFrame:
    """``keep`` of every row with ``lang_pred``, ``score``, ``languages``, ``proportions``
    and ``fit``.

    ``score`` is the predicted language's share of the text, ``fit`` as ``judge`` has it. A
    null text, one without a letter, and any text under an empty model get ``und`` and 0. Rows are
    judged by their text alone: repeated rows get equal answers, nothing is
    shuffled, other columns of ``docs`` do not matter.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model.languages, model.log_p))
    names = ("lang_pred", "score", "languages", "proportions", "fit")
    source = docs.select(F.col(text).alias("__text"), *keep)
    out = (
        source.drop("__text").schema.add(names[0], "string").add(names[1], "double")
        .add(names[2], ArrayType(StringType())).add(names[3], ArrayType(DoubleType())).add(names[4], "double")
    )

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = LanguageModel(*shared.value)
        for batch in slices(batches):
            judged = [
                ({}, 0.0) if t is None else held.judge(t.decode("utf-8", "replace"), penalty)
                for t in as_bytes(batch.column(0))
            ]
            found = [f for f, _ in judged]
            first = [next(iter(f.items()), (UNDETERMINED, 0.0)) for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[1:],
                    pa.array([f[0] for f in first], pa.string()),
                    pa.array([min(1.0, max(0.0, f[1])) for f in first], pa.float64()),
                    pa.array([list(f) for f in found], pa.list_(pa.string())),
                    pa.array([list(f.values()) for f in found], pa.list_(pa.float64())),
                    pa.array([f for _, f in judged], pa.float64()),
                ],
                names=[*schema_names, *names],
            )

    schema_names = source.columns[1:]
    return source.mapInArrow(judge, out)
