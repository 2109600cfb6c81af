import hashlib
import math
from collections import Counter

import pytest
from llm_cases import DOCUMENTS, documents, frame

from siltstone.llm import mixing


def words(text):
    return len((text or "").split()) if text is None or text.isascii() else len(text.encode().split())


def exponent(tokens, entropy_share, most_epochs, budget_share):
    """By a fine plain search."""
    total = sum(tokens)
    shares = [t / total for t in tokens if t]

    def weights(x):
        z = sum(p**x for p in shares)
        return [p**x / z for p in shares]

    def bisect(up):
        lo, hi = 0.0, 1.0
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if up(mid) else (lo, mid)
        return hi

    found = 0.0 if entropy_share is not None or most_epochs is not None else 1.0
    if entropy_share is not None:
        target = entropy_share * math.log(len(shares))
        found = max(found, bisect(lambda x: -sum(w * math.log(w) for w in weights(x)) > target))
    if most_epochs is not None:
        found = max(found, bisect(lambda x: max(w / p for w, p in zip(weights(x), shares)) * budget_share > most_epochs))
    return found


def expected(rows, entropy_share=0.95, most_epochs=4.0, budget_share=1.0):
    """id, source, epoch of every copy."""
    sources = {}
    for r in rows:
        sources.setdefault(r[3], []).append((r[0], words(r[1])))
    tokens = {s: sum(n for _, n in d) for s, d in sources.items()}
    total = sum(tokens.values())
    x = exponent(sorted(tokens.values()), entropy_share, most_epochs, budget_share)
    z = sum((t / total) ** x for t in tokens.values() if t)
    out = []
    for s, docs in sources.items():
        if not tokens[s]:
            out += [(i, s, 0) for i, _ in docs]
            continue
        budget = math.floor((tokens[s] / total) ** x / z * math.floor(total * budget_share))
        epochs, rest = divmod(budget, tokens[s])
        out += [(i, s, e) for e in range(epochs) for i, _ in docs]
        groups = {}
        for i, n in docs:
            h = hashlib.md5(f"{'null' if i is None else i}:{epochs}".encode()).hexdigest()
            groups.setdefault(h, []).append((i, n))
        upto = 0
        for h in sorted(groups):
            upto += sum(n for _, n in groups[h])
            if rest > 0 and upto <= rest:
                out += [(i, s, epochs) for i, _ in groups[h]]
    return out


SETTINGS = [
    {}, {"entropy_share": 1.0, "most_epochs": None}, {"entropy_share": None, "most_epochs": 1.2},
    {"entropy_share": None, "most_epochs": None}, {"budget_share": 2.5}, {"budget_share": 0.3, "most_epochs": None},
]


@pytest.mark.parametrize("settings", SETTINGS, ids=map(str, SETTINGS))
def test_copies_against_plain_python(spark, settings):
    rows = documents(long_words=300)
    narrow = mixing.narrow_rows(frame(spark, rows))
    got = mixing.schedule(narrow, mixing.plan(narrow, **settings)).collect()
    want = Counter(map(repr, expected(rows, **settings)))
    assert Counter(repr((r["i"], r["source"], r["epoch"])) for r in got) == want


def test_many_sources_are_joined_with_salt(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    rows = documents(long_words=300)
    assert Counter(r["doc_id"] for r in mixing.mix(frame(spark, rows)).collect()) == Counter(
        i for i, _, _ in expected(rows)
    )


def test_blocks_are_permutations_with_even_shares(spark):
    rows = [(i, "w " * (1 + i % 7), "en", "ab"[i % 3 == 0], 1) for i in range(3000)]
    narrow = mixing.narrow_rows(frame(spark, rows))
    got = mixing.schedule(narrow, mixing.plan(narrow), block_tokens=2000).collect()
    blocks = {}
    for r in got:
        blocks.setdefault(r["block"], []).append(r)
    total = sum(r["n"] for r in got)
    assert len(blocks) == math.ceil(sum(words(r[1]) for r in rows) / 2000)
    whole = Counter()
    for r in got:
        whole[r["source"]] += r["n"]
    for members in blocks.values():
        assert sorted(r["position"] for r in members) == list(range(len(members)))
        own = Counter()
        for r in members:
            own[r["source"]] += r["n"]
        for s, n in whole.items():
            assert abs(own[s] / sum(own.values()) - n / total) < 0.02


def test_weights_meet_the_entropy(spark):
    rows = [(i, "w " * 5, "en", f"s{min(9, int(i**0.5) // 3)}", 1) for i in range(900)]
    plan = mixing.plan(mixing.narrow_rows(frame(spark, rows)), 0.97, None).collect()
    assert math.isclose(sum(r["weight"] for r in plan), 1)
    entropy = -sum(r["weight"] * math.log(r["weight"]) for r in plan)
    assert math.isclose(entropy, 0.97 * math.log(len(plan)), rel_tol=1e-6)
    limited = mixing.plan(mixing.narrow_rows(frame(spark, rows)), None, 1.5).collect()
    assert math.isclose(max(r["weight"] * 4500 / r["tokens"] for r in limited), 1.5, rel_tol=1e-6)


def test_rows_of_the_mixture(spark):
    rows = documents(long_words=300)
    docs = frame(spark, rows)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter(i for i, _, _ in expected(rows))


def test_empty_tables_and_texts(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    narrow = mixing.narrow_rows(empty)
    assert mixing.schedule(narrow, mixing.plan(narrow)).count() == 0 and mixing.mix(empty).count() == 0
    blank = [(i, None, None, None, None) for i in range(5)]
    assert mixing.mix(frame(spark, blank)).count() == 5
