"""Benchmark decontamination by greedy string tiling.

Texts are word sequences.  A running Karp-Rabin hash of every ``min_match``
successive words of a document is looked up among those of the benchmark
items; a document and an item that share such a seed are a candidate pair.
Seeds that follow each other in both texts are one match.  Then the longest
match whose words are all unmarked becomes a tile and its words are marked;
matches that overlap it are cut back and compete again, until none of
``min_match`` words is left.  Tiles may lie in any order, so an item whose
parts were moved about is still covered.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_rows, read_table, text_of
from .words import hashed_words, runs

#: Benchmark words that one pass over the documents looks for (about 60 MB broadcast).
PASS_WORDS = 1_000_000


def tiles(hits_d: np.ndarray, hits_i: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """Greedy tiling from seed hits (word positions in document and item).

    Returns (document position, item position, length), longest first; of equal
    lengths the one that comes first in the document, then in the item."""
    order = np.lexsort((hits_d, hits_d - hits_i))
    d, i = hits_d[order], hits_i[order]
    new = np.flatnonzero(np.r_[True, (np.diff(d) != 1) | (np.diff(i) != 1)])
    length = np.diff(np.r_[new, len(d)]) + k - 1
    heap = [(-int(n), int(a), int(b)) for n, a, b in zip(length, d[new], i[new])]
    heapq.heapify(heap)
    base = int(d.min())
    marked_d, marked_i = np.zeros(int(d.max()) - base + k, bool), np.zeros(int(i.max()) + k, bool)
    found = []
    while heap:
        n, a, b = heapq.heappop(heap)
        n = -n
        taken = marked_d[a - base:a - base + n] | marked_i[b:b + n]
        if not taken.any():
            marked_d[a - base:a - base + n] = True
            marked_i[b:b + n] = True
            found.append((a, b, n))
            continue
        bounds = np.flatnonzero(np.diff(np.r_[True, taken, True].astype(np.int8)))
        for s, e in zip(bounds[::2], bounds[1::2]):
            if e - s >= k:
                heapq.heappush(heap, (-int(e - s), a + int(s), b + int(s)))
    return found


class Seeds:
    """All runs of ``k`` words of some items, looked up by hash."""

    def __init__(self, k: int, items: list[tuple[int, np.ndarray]]):
        self.k, self.items = k, items
        keys = [runs(words, k) for _, words in items]
        key = np.concatenate(keys)
        item = np.repeat(np.arange(len(items)), [len(x) for x in keys])
        at = np.concatenate([np.arange(len(x)) for x in keys])
        order = np.argsort(key, kind="stable")
        self.key, self.item, self.at = key[order], item[order], at[order]
        self.coarse = np.zeros(1 << 20, bool)
        self.coarse[key >> np.uint64(44)] = True

    def hits(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, item, position in the item) of every seed of a word sequence."""
        if len(words) < self.k:
            return (np.zeros(0, np.int64),) * 3
        key = runs(words, self.k)
        at = np.flatnonzero(self.coarse[key >> np.uint64(44)])
        low, high = np.searchsorted(self.key, key[at], "left"), np.searchsorted(self.key, key[at], "right")
        n = high - low
        pick = np.repeat(low - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        return np.repeat(at, n), self.item[pick], self.at[pick]


def _search(seeds: list[Seeds], threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), []
            data, offsets = binary_rows(batch.column(1))
            for first, hashes, bounds in hashed_words(data, offsets):
                for s in seeds:
                    at, item, pos = s.hits(hashes)
                    row = np.searchsorted(bounds, at, "right") - 1
                    inside = at + s.k <= bounds[row + 1] if len(at) else np.zeros(0, bool)
                    at, item, pos, row = at[inside], item[inside], pos[inside], row[inside]
                    order = np.lexsort((item, row))
                    at, item, pos, row = at[order], item[order], pos[order], row[order]
                    cuts = np.flatnonzero(np.r_[True, (np.diff(row) != 0) | (np.diff(item) != 0)]) if len(row) else []
                    for i, j in zip(cuts, np.r_[cuts[1:], len(row)] if len(row) else []):
                        item_id, words = s.items[item[i]]
                        reach = np.zeros(len(words) + 1, np.int64)
                        np.add.at(reach, pos[i:j], 1)
                        np.add.at(reach, pos[i:j] + s.k, -1)
                        if (np.cumsum(reach[:-1]) > 0).sum() < threshold * len(words):
                            continue  # not even all matches together cover enough
                        found = tiles(at[i:j], pos[i:j], s.k)
                        covered = sum(n for _, _, n in found)
                        if covered >= threshold * len(words):
                            start = int(bounds[row[i]])
                            out.append((ids[first + int(row[i])], item_id, covered / len(words), len(found), found[0][2],
                                        [(a - start, b, n) for a, b, n in found]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(zip(*out) if out else [[]] * 6, _SCHEMA.types)], schema=_SCHEMA)
    return run


_TILE = pa.list_(pa.struct([("doc_word", pa.int64()), ("item_word", pa.int64()), ("words", pa.int64())]))
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("coverage", pa.float64()), ("n_tiles", pa.int32()),
                     ("longest", pa.int32()), ("tiles", _TILE)])
_DDL = ("doc_id long, item_id long, coverage double, n_tiles int, longest int, "
        "tiles array<struct<doc_word: long, item_word: long, words: long>>")


def contaminated(docs: DataFrame, benchmark: DataFrame, min_match: int = 5, threshold: float = 0.5) -> DataFrame:
    """Pairs of a document and a benchmark item of whose words tiles cover at
    least ``threshold``: doc_id, item_id, coverage, n_tiles, longest, tiles.

    Words are lower-cased A-Z runs between white space.  An item shorter than
    ``min_match`` words must occur whole.  Null and empty texts and items match
    nothing; rows with a null doc_id are searched and carry the null; repeated
    rows and items are reported each.  Other columns are ignored; empty tables
    give no rows.  The items are broadcast in passes of at most about
    PASS_WORDS words (counted first), one scan of the documents each.
    """
    spark = docs.sparkSession
    items = benchmark.select("item_id", text_of().cast("binary").alias("bytes"))
    total = items.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    passes = max(1, -(-total // (PASS_WORDS * 6)))
    texts = docs.select("doc_id", text_of().cast("binary").alias("bytes"))
    found = None
    for p in range(passes):
        part = items if passes == 1 else items.where(F.pmod(F.xxhash64("item_id", "bytes"), F.lit(passes)) == p)
        rows = [(r.item_id, np.array(bytearray(r.bytes), np.uint8)) for r in part.collect()]
        words = [(i, np.concatenate([h for _, h, _ in hashed_words(b, np.array([0, len(b)]))])) for i, b in rows if len(b)]
        by_length: dict[int, list] = {}
        for i, w in words:
            if len(w):
                by_length.setdefault(min(min_match, len(w)), []).append((i, w))
        seeds = [Seeds(k, part) for k, part in sorted(by_length.items())]
        shared = spark.sparkContext.broadcast(seeds)
        one = texts.mapInArrow(_search_shared(shared, threshold), _DDL)
        found = one if found is None else found.unionByName(one)
    return found


def _search_shared(shared, threshold: float):
    def run(batches):
        yield from _search(shared.value, threshold)(batches)
    return run


def op4_decontamination(spark, sf_dir: str) -> DataFrame:
    """Documents that hold ``benchmark`` items, by tile coverage."""
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
