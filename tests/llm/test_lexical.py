"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from routecov.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text):
    return Counter(TERM.findall((text or "").translate(ASCII)))


def _brute(docs, items, k=20):
    counts = [(d, _terms(t)) for d, t in docs]
    counts = [(d, c, c.total()) for d, c in counts if c]
    n, total = len(counts), sum(x for _, _, x in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in set(items):
        own = _terms(text)
        scores = []
        for d, c, size in counts:
            m = 75 + 25 * size * n // total
            s = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t, q in own.items() if t in c)
            if s > 0:
                scores.append((-s, d is not None, d or 0))
        out += [(item, r, d if there else None, -s) for r, (s, there, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def _texts(seed, n, words=40):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["É", "é", "ABC", "abc", "naïve", "\U0001f600x"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    return [rnd.choice([" ", "-", "\n"]).join(rnd.choices(vocabulary, weights, k=rnd.randint(1, 30))) for _ in range(n)]


@pytest.mark.parametrize("k", [1, 3, 20])
def test_equals_brute_force(spark, monkeypatch, k):
    monkeypatch.setattr(lexical, "PASS_BYTES", 300)
    docs = [(i, t) for i, t in enumerate(_texts(1, 400))]
    docs += [(1000 + i, "w1 w2 w3") for i in range(50)] + [(5, docs[5][1]), (None, "w3 w9"), (None, None), (7, ""), (8, " .!"), (9, "W1 " * 3000)]
    items = [(i, t) for i, t in enumerate(_texts(2, 12))] + [(0, "w1"), (0, "w1"), (50, None), (51, ""), (52, "unknown words"), (None, "w2 w39 w2")]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as n", "2 as terms", "3 as score").repartition(5)
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as rank").repartition(2)
    assert sorted(map(tuple, lexical.ranked(d, q, k).collect()), key=str) == _brute(docs, [i for i in items if i[1] is not None], k)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    q = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.ranked(d.limit(0), q).collect() == [] and lexical.ranked(d, q.limit(0)).collect() == []
    assert lexical.ranked(d.selectExpr("doc_id", "cast(null as string) as text"), q).collect() == []
    assert [tuple(r) for r in lexical.ranked(d, q).collect()] == _brute([(1, "a b")], [(1, "a")])


def test_long_text_is_read_whole(monkeypatch):
    monkeypatch.setattr(lexical, "LONG_TEXT", 10)
    text = "Ab c1 \x7f É " * 100
    assert {t.decode(): c for t, c in lexical.term_counts(text.encode()).items()} == dict(_terms(text))


def _opened(docs, asked, n, total):
    own = []
    for d, c, size in docs:
        pairs = sorted((asked.terms[t], x) for t, x in c.items() if t in asked.terms)
        own.append((d, size, lexical.np.array([t for t, _ in pairs], lexical.np.int32), lexical.np.array([x for _, x in pairs], lexical.np.int32)))
    names = [f.split()[0] for f in lexical.INDEX.split(", ")]
    return lexical.Block(dict(zip(names, lexical._block(0, own, asked, n, total))))


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 60), st.integers(0, 3))
def test_bounds_hold_and_nothing_is_lost(seed, n, floor_rank):
    """Every document of a block: no beginning of the list adds up to more than its bound, and none at the floor is missed."""
    docs = [(i, lexical.term_counts(t.encode())) for i, t in enumerate(_texts(seed, n, 8))]
    docs = [(d, c, c.total()) for d, c in docs]
    asked = lexical.Asked([(1, " ".join(_texts(seed + 1, 2, 8)).encode())])
    df = Counter(asked.terms[t] for _, c, _ in docs for t in c if t in asked.terms)
    asked.weigh(n, df)
    block = _opened(docs, asked, n, sum(s for _, _, s in docs))
    terms = asked.items[0]
    front = sorted(((t, c) for t, c in terms if block.most[t] > 0), key=lambda x: (x[1] * int(block.most[x[0]]), x[0]))
    bounds = lexical._matched(front, block, asked.pair_of)
    scores = lexical.np.zeros((len(front) + 1, n), lexical.np.int64)
    for j, (t, c) in enumerate(front):
        at, impacts = block.postings(t)
        scores[j + 1] = scores[j]
        scores[j + 1][at] += c * impacts
        assert scores[j + 1].max() <= bounds[j + 1] and bounds[j] <= bounds[j + 1]
    final = scores[-1]
    floor = sorted(final, reverse=True)[min(floor_rank, n - 1)]
    found, got = lexical.best(block, terms, asked.pair_of, max(1, int(floor)), k=3)
    assert (final[found] == got).all()
    want = sorted(((-s, i) for i, s in enumerate(final) if s >= max(1, floor)))[:3]
    assert set(i for _, i in want) <= set(found.tolist())
