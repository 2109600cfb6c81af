"""Token counts of a unigram tokenizer without its tokens.

An Aho-Corasick automaton finds all vocabulary pieces in a word; dynamic
programming keeps, for every position, the best score and how many pieces it takes.
Ties go as in the tokenizer: of equal scores the longer last piece stays.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import slices

MARK = "▁"  # stands for a space in pieces
#: What an unknown character costs beyond the least score, as in the tokenizer.
UNKNOWN_PENALTY = 10.0
#: Marks and what follows them up to the next.
WORD = re.compile(f"{MARK}+[^{MARK}]*")
#: Words whose counts a worker remembers; only speed depends on it.
KNOWN_WORDS = 300_000


def vocabulary(model_path: str) -> list[tuple[str, float]]:
    """Pieces of a sentencepiece model file with unigram scores.

    The file's pieces are in order of merging, not scored as a unigram model, so a
    piece's probability is taken to fall as one over its rank.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    special = [i for i in range(model.get_piece_size()) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)]
    skipped = set(special)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if i not in skipped]
    return [(p, -math.log(rank + 1)) for rank, p in enumerate(pieces, 1)]


def has_bytes(model_path: str) -> bool:
    """Whether a sentencepiece model file has a piece for each byte of unknown characters."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    return sum(map(model.is_byte, range(model.get_piece_size()))) == 256


class UnigramCounter:
    """Counts as a unigram model with these pieces would make.

    With ``byte_fallback`` an unknown character is as many pieces as it has UTF-8
    bytes, and none of them is unknown; else unknown runs are fused. With ``split``
    each space starts a word, and so does the text. Without, the text has a mark put
    before it whatever it starts with, as in sentencepiece, and pieces may hold more
    than one.
    """

    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool = False, split: bool = True):
        self.byte_fallback, self.split = byte_fallback, split
        # Pieces that go on past a space, and unknown runs that do, need the text in one.
        crossing = any(re.search(f"[^{MARK}]{MARK}", p) for p, _ in pieces)
        fused_marks = not byte_fallback and MARK not in (p for p, _ in pieces)
        self.whole = not split and (crossing or fused_marks)
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece not in self.automaton:
                self.automaton.add_word(piece, (len(piece), score))
        if pieces:
            self.automaton.make_automaton()
        self.longest = max((len(p) for p, _ in pieces), default=1)
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.empty = not pieces
        self.known: dict[str, tuple[int, int, float]] = {}

    def word(self, word: str) -> tuple[int, int, float]:
        """Pieces, unknown ones among them, and the score of the best split of a word.

        Only as many positions are held as the longest piece has characters.
        """
        if not word:
            return 0, 0, 0.0
        size = self.longest + 1
        score, count, unknown = [0.0] * size, [0] * size, [0] * size
        fused = [False] * size  # does the best way there end in an unknown run
        matches = iter(()) if self.empty else self.automaton.iter(word)
        following = next(matches, None)
        for end in range(len(word)):
            best, start, single = -math.inf, -1, False
            while following is not None and following[0] == end:
                length, value = following[1]
                single = single or length == 1
                total = value + score[(end + 1 - length) % size]
                if total > best or (total == best and end + 1 - length < start):
                    best, start = total, end + 1 - length
                following = next(matches, None)
            slot = (end + 1) % size
            ends_unknown = False
            if not single:
                total = self.unknown + score[end % size]
                if total > best:
                    best, start, ends_unknown = total, end, True
            at = start % size
            if ends_unknown and self.byte_fallback:
                counted = count[at] + len(word[end].encode()), unknown[at]
            else:
                more = 0 if ends_unknown and fused[at] else 1
                counted = count[at] + more, unknown[at] + (more if ends_unknown else 0)
            score[slot], fused[slot] = best, ends_unknown
            count[slot], unknown[slot] = counted
        last = len(word) % size
        return count[last], unknown[last], score[last]

    def text(self, text: str) -> tuple[int, int, float]:
        """The same over a text."""
        if not text:
            return 0, 0, 0.0
        marked = text.replace(" ", MARK)
        if self.whole:
            return self.word(MARK + marked)
        if self.split:
            words = (marked[1:] if marked.startswith(MARK) else marked).split(MARK)
        else:  # each word with the marks before it, less one
            words = [w[1:] for w in WORD.findall(MARK + marked)]
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        found = list(map(self.known.get, words))
        if None in found:
            for i, f in enumerate(found):
                if f is None:
                    word = words[i]
                    found[i] = self.known.get(word) or self.known.setdefault(word, self.word(MARK + word))
        counts, unknown, scores = zip(*found)
        return sum(counts), sum(unknown), math.fsum(scores)


def token_counts(
    docs: DataFrame, pieces: list[tuple[str, float]], keep: list[Column], text: str = "text",
    byte_fallback: bool = False, split: bool = True,
) -> DataFrame:
    """``keep`` of each row with ``n_tokens``, ``n_unknown`` and ``score`` of its text.

    Null and empty texts have no tokens and score 0. Rows are counted where they
    lie; repeated rows get equal counts, other columns are not read. The vocabulary
    is broadcast: its size is the tokenizer's, not the input's.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(pieces)
    source = docs.select(F.col(text).alias("__text"), *keep)
    schema = source.drop("__text").schema.add("n_tokens", "long").add("n_unknown", "long").add("score", "double")
    names = schema.names

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = UnigramCounter(shared.value, byte_fallback, split)
        for batch in slices(batches):
            n, unknown, score = [], [], []
            for t in batch.column(0).to_pylist():
                a, b, c = counter.text(t or "")
                n.append(a)
                unknown.append(b)
                score.append(c)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(n, pa.int64()), pa.array(unknown, pa.int64()), pa.array(score, pa.float64())],
                names=names,
            )

    return source.mapInArrow(count, schema)
