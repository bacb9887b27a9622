"""Greedy string tiling against a plain implementation."""

import random

import numpy as np

from corpus_frames import frame  # noqa: F401 - a fixture
from routecov.llm import tiling


def plain_tiles(doc, item, k):
    """Repeatedly the longest unmarked common run, first in the document, then in the item."""
    d, i, out = [False] * len(doc), [False] * len(item), []
    while True:
        best = None
        for a in range(len(doc)):
            for b in range(len(item)):
                n = 0
                while a + n < len(doc) and b + n < len(item) and doc[a + n] == item[b + n] and not d[a + n] and not i[b + n]:
                    n += 1
                if n >= k and (best is None or n > best[2]):
                    best = (a, b, n)
        if best is None:
            return out
        a, b, n = best
        for x in range(n):
            d[a + x] = i[b + x] = True
        out.append(best)


def test_tiles_equal_plain_tiling():
    rnd = random.Random(2)
    for _ in range(150):
        doc = [rnd.randint(0, 3) for _ in range(rnd.randint(3, 40))]
        item = [rnd.randint(0, 3) for _ in range(rnd.randint(3, 15))]
        seeds = tiling.Seeds(3, [(0, np.array(item, np.uint64))])
        at, _, pos = seeds.hits(np.array(doc, np.uint64))
        got = tiling.tiles(at, pos, 3) if len(at) else []
        want = plain_tiles(doc, item, 3)
        assert [n for _, _, n in got][:1] == [n for _, _, n in want][:1]
        assert got == want


def test_finds_whole_reordered_and_short_items(spark, frame):
    words = [f"w{i}" for i in range(40)]
    moved = words[20:] + ["z"] + words[:20]
    items = spark.createDataFrame([(1, " ".join(words)), (2, "tiny item"), (3, None), (4, ""), (5, " ".join(f"q{i}" for i in range(30)))],
                                  "item_id long, text string")
    filler = " ".join(f"f{i % 313}" for i in range(50_000))
    rows = [(1, filler + " " + " ".join(words).upper() + " " + filler), (2, "a " + " ".join(moved) + " b"), (3, "some tiny item here"),
            (4, " ".join(words[:12])), (5, None), (6, ""), (7, "tiny"), (None, " ".join(words)), (8, " ".join(f"q{i}" for i in range(14)))]
    got = {(r.doc_id, r.item_id): r for r in tiling.contaminated(frame(rows), items).collect()}
    assert set(got) == {(1, 1), (2, 1), (3, 2), (None, 1)}
    assert got[1, 1].coverage == 1.0 and got[1, 1].n_tiles == 1 and got[1, 1].tiles[0].doc_word == 50_000
    assert got[2, 1].coverage == 1.0 and got[2, 1].n_tiles == 2
    assert tiling.contaminated(frame([]), items).collect() == []
    assert tiling.contaminated(frame(rows), items.limit(0)).collect() == []


def test_several_passes(spark, frame, monkeypatch):
    items = spark.createDataFrame([(i, " ".join(f"i{i}w{j}" for j in range(20))) for i in range(12)], "item_id long, text string")
    docs = frame([(i, f"x i{i}w0 " + " ".join(f"i{i}w{j}" for j in range(20))) for i in range(12)])
    monkeypatch.setattr(tiling, "PASS_WORDS", 80)
    assert sorted((r.doc_id, r.item_id) for r in tiling.contaminated(docs, items).collect()) == [(i, i) for i in range(12)]
