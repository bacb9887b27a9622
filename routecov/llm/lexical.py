"""Ranked lexical search with MaxScore and bounds on term pairs.

The index is partitioned by documents: a block holds, for some thousand
documents, the postings of each asked term with their integer impacts, the
term's largest impact, and, for each chosen pair of terms, the intersection of
their postings with the largest joint impact in it.  Blocks are made where the
documents lie, so no list of one term is ever gathered.

A search takes the terms of an item by ascending largest impact.  Those at the
front whose bounds together stay below the score of the k-th best document so
far cannot lift a document into the result by themselves; only postings of the
others make candidates.  Two terms with a pair list add up to at most the
largest of their own impacts and of the joint one, so pairs are matched within
the front (largest saving first), which lets it reach further and lets
candidates be dropped earlier when the front's lists are looked up.  The k-th
best score is carried from block to block of a task; a block whose bound for
an item is below it is skipped.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routecov.session import scratch_path

from .common import read_table

TOP = 20
#: A block ends at this many postings or documents.
BLOCK_POSTINGS, BLOCK_DOCS = 1 << 19, 1 << 14
#: Items of about this many bytes of text are searched for in one pass over the documents.
PASS_BYTES = 8 << 20
#: Longer texts are read term by term instead of as one list.
LONG_TEXT = 1 << 22

# A term is a run of ASCII digits, ASCII letters and all that is not ASCII; only A to Z change case.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")

COUNTED = "doc_id long, n long, terms binary, tfs binary"
INDEX = ("block long, doc_ids binary, starts binary, docs binary, impacts binary, most binary, "
         "pair_starts binary, pair_docs binary, joint binary")


def term_counts(text: bytes) -> Counter:
    """Occurrences of each term of a whole text in UTF-8."""
    text = text.lower()  # of bytes: ASCII letters only
    return Counter(TERM.findall(text) if len(text) < LONG_TEXT else (m.group() for m in TERM.finditer(text)))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Asked:
    """The items of one pass: numbered terms, their occurrences in each item, and the pairs that get lists.

    An item's terms, from the rarest on, are paired with the next: pairs of
    rare terms save most.  Which pairs there are changes no result."""

    def __init__(self, items: list[tuple[int, bytes]]):
        counts = [term_counts(text) for _, text in items]
        self.ids = [i for i, _ in items]
        self.terms = {t: k for k, t in enumerate(sorted(set().union(*counts)))}
        self.items = [sorted((self.terms[t], c) for t, c in own.items()) for own in counts]

    def weigh(self, n_docs: int, dfs: dict[int, int]) -> None:
        """Set the weights of the terms and choose the pairs."""
        self.weights = np.array([weight(n_docs, dfs.get(t, 0)) for t in range(len(self.terms))], np.int64)
        pairs: dict[tuple[int, int], int] = {}
        for own in self.items:
            by_rarity = sorted((t for t, _ in own), key=lambda t: (-self.weights[t], t))
            for a, b in zip(by_rarity, by_rarity[1:]):
                pairs.setdefault((min(a, b), max(a, b)), len(pairs))
        self.pairs = np.array(list(pairs), np.int64).reshape(-1, 2)
        self.pair_of = pairs


def passes(items: DataFrame, size: int = PASS_BYTES) -> Iterator[Asked]:
    """The distinct items (item_id, text) with text, some megabytes at a time."""
    known = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text")).where("text is not null").distinct()
    total = known.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(1, -(-total // size))
    for k in range(n):
        own = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        if own:
            yield Asked(sorted(((r["item_id"], bytes(r["text"])) for r in own), key=lambda r: (r[0] is not None, r[0] or 0, r[1])))


def counted(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """doc_id, number of terms and occurrences of the asked ones (int32 arrays, by number), for documents with a term."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                if not text.is_valid:
                    continue
                counts = term_counts(text.as_py())
                if not counts:
                    continue
                own = sorted((number[t], c) for t, c in counts.items() if t in number)
                out.append((doc_id.as_py(), counts.total(), np.array([t for t, _ in own], np.int32).tobytes(),
                            np.array([c for _, c in own], np.int32).tobytes()))
            columns = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int64(), pa.binary(), pa.binary()])],
                                             ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, COUNTED)


def document_frequencies(counts: DataFrame) -> dict[int, int]:
    """Documents with each asked term; the driver gets one number a term of the pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for terms in batch["terms"]:
                seen.update(np.frombuffer(terms.as_py(), np.int32).tolist())
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int32()), pa.array(list(seen.values()), pa.int64())], ["term", "df"])
    return {r["term"]: r["df"] for r in counts.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()}


def _block(number: int, docs: list, asked: Asked, n_docs: int, n_terms: int) -> tuple:
    """One row of the index: postings by term as one array each, with starts."""
    size = np.array([len(t) for _, _, t, _ in docs])
    doc = np.repeat(np.arange(len(docs), dtype=np.int32), size)
    term, tf = np.concatenate([t for _, _, t, _ in docs]), np.concatenate([f for _, _, _, f in docs]).astype(np.int64)
    m = np.array([75 + 25 * n * n_docs // n_terms for _, n, _, _ in docs], np.int64)[doc]
    impact = asked.weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m))
    order = np.argsort(term, kind="stable")
    doc, impact = doc[order], impact[order]
    starts = np.searchsorted(term[order], np.arange(len(asked.weights) + 1)).astype(np.int64)
    most = np.zeros(len(asked.weights), np.int64)
    held = starts[:-1] < starts[1:]
    if len(impact):
        most[held] = np.maximum.reduceat(impact, starts[:-1][held])
    pair_docs, pair_starts, joint = [], [0], []
    for a, b in asked.pairs:
        one, other = slice(starts[a], starts[a + 1]), slice(starts[b], starts[b + 1])
        both, i, j = np.intersect1d(doc[one], doc[other], assume_unique=True, return_indices=True)
        joint.append(int((impact[one][i] + impact[other][j]).max()) if len(both) else 0)
        pair_docs.append(both)
        pair_starts.append(pair_starts[-1] + len(both))
    together = np.concatenate(pair_docs) if pair_docs else np.zeros(0)
    ids = pa.array([d for d, _, _, _ in docs], pa.int64())
    # a null id is told apart by the first byte of a flag each
    flags = np.array([d is not None for d, _, _, _ in docs], np.int64)
    return (number, np.stack([flags, ids.fill_null(0).to_numpy()]).tobytes(), starts.tobytes(), doc.tobytes(), impact.tobytes(), most.tobytes(),
            np.array(pair_starts, np.int64).tobytes(), together.astype(np.int32).tobytes(), np.array(joint, np.int64).tobytes())


def index(counts: DataFrame, asked: Asked, n_docs: int, n_terms: int, postings: int = BLOCK_POSTINGS, documents: int = BLOCK_DOCS) -> DataFrame:
    """Blocks (INDEX) of counted documents that hold an asked term, made where they lie."""
    shared = counts.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, docs, held, number = shared.value, [], 0, 0

        def made() -> pa.RecordBatch:
            row = _block(number, docs, known, n_docs, n_terms)
            return pa.RecordBatch.from_arrays([pa.array([row[0]], pa.int64()), *[pa.array([x], pa.binary()) for x in row[1:]]],
                                              [f.split()[0] for f in INDEX.split(", ")])

        for batch in batches:
            for doc_id, n, terms, tfs in zip(*[batch[c] for c in ("doc_id", "n", "terms", "tfs")]):
                own = np.frombuffer(terms.as_py(), np.int32)
                if not len(own):
                    continue
                docs.append((doc_id.as_py(), n.as_py(), own, np.frombuffer(tfs.as_py(), np.int32)))
                held += len(own)
                if held >= postings or len(docs) >= documents:
                    yield made()
                    docs, held, number = [], 0, number + 1
        if docs:
            yield made()

    return counts.mapInArrow(run, INDEX)


class Block:
    """One block of the index, opened."""

    def __init__(self, row: dict):
        def array(name: str, kind=np.int64) -> np.ndarray:
            return np.frombuffer(row[name], kind)
        self.flags, self.ids = array("doc_ids").reshape(2, -1)
        self.starts, self.docs, self.impacts, self.most = array("starts"), array("docs", np.int32), array("impacts"), array("most")
        self.pair_starts, self.pair_docs, self.joint = array("pair_starts"), array("pair_docs", np.int32), array("joint")

    def postings(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        one = slice(self.starts[t], self.starts[t + 1])
        return self.docs[one], self.impacts[one]


def _matched(front: list[tuple[int, int]], block: Block, pair_of: dict) -> list[int]:
    """For the terms (number, occurrences) of ``front``: bounds of its beginnings, from none to all terms.

    Pairs are matched greedily over the whole list; a beginning takes a pair's
    bound where it holds both terms, else each term's own."""
    saved = []
    most = [c * int(block.most[t]) for t, c in front]
    place = {t: k for k, (t, _) in enumerate(front)}
    for k, (a, ca) in enumerate(front):
        for j in range(k + 1, len(front)):
            b, cb = front[j]
            p = pair_of.get((min(a, b), max(a, b)))
            if p is not None:
                # occurrences weigh the joint impact by the larger count
                together = max(most[k], most[j], max(ca, cb) * int(block.joint[p]))
                if together < most[k] + most[j]:
                    saved.append((most[k] + most[j] - together, a, b))
    taken, gain = set(), [0] * len(front)
    for s, a, b in sorted(saved, key=lambda x: (-x[0], x[1], x[2])):
        if a not in taken and b not in taken:
            taken |= {a, b}
            gain[max(place[a], place[b])] += s
    bounds = [0]
    for k in range(len(front)):
        bounds.append(bounds[-1] + most[k] - gain[k])
    return bounds


def best(block: Block, terms: list[tuple[int, int]], pair_of: dict, floor: int, k: int = TOP) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a block (places, scores) that may be among the k best of an item, ``floor`` being a score reached k times.

    All documents with a score above 0 and at least ``floor`` are found, or the
    k best of them and their equals."""
    front = sorted(((t, c) for t, c in terms if block.most[t] > 0), key=lambda x: (x[1] * int(block.most[x[0]]), x[0]))
    none = np.zeros(0, np.int64)
    if not front:
        return none, none
    bounds = _matched(front, block, pair_of)
    if bounds[-1] < floor:
        return none, none
    # the longest beginning that cannot reach the floor alone
    cut = max(j for j in range(len(front)) if j == 0 or bounds[j] < floor)
    score = np.zeros(len(block.ids), np.int64)
    for t, c in front[cut:]:
        docs, impacts = block.postings(t)
        score[docs] += c * impacts
    found = np.flatnonzero(score)
    score = score[found]
    for j in range(cut - 1, -1, -1):
        if len(found) > k:
            floor = max(floor, int(np.partition(score, len(score) - k)[len(score) - k]))
        alive = score + bounds[j + 1] >= floor
        found, score = found[alive], score[alive]
        if not len(found):
            return none, none
        t, c = front[j]
        docs, impacts = block.postings(t)
        at = np.searchsorted(docs, found)
        at[at == len(docs)] = 0
        score = score + np.where(docs[at] == found, c * impacts[at], 0)
    if len(found) > k:
        floor = max(floor, int(np.partition(score, len(score) - k)[len(score) - k]))
    kept = score >= max(floor, 1)
    return found[kept], score[kept]


def searched(blocks: DataFrame, asked: Asked, k: int = TOP) -> DataFrame:
    """(item, item_id, doc_id, score): each task's k best documents of each item."""
    shared = blocks.sparkSession.sparkContext.broadcast(asked)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        # of each item: scores (negative), whether the id is there, ids of the k best, in order
        tops = [np.zeros((3, 0), np.int64) for _ in known.items]
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch.slice(i, 1).to_pylist()[0])
                for q, terms in enumerate(known.items):
                    top = tops[q]
                    floor = -int(top[0, -1]) if top.shape[1] == k else 1
                    docs, score = best(block, terms, known.pair_of, floor, k)
                    if len(docs):
                        both = np.concatenate([top, np.stack([-score, block.flags[docs], block.ids[docs]])], axis=1)
                        tops[q] = both[:, np.lexsort(both[::-1])[:k]]
        for q, top in enumerate(tops):
            if top.shape[1]:
                size = top.shape[1]
                ids = pa.array(top[2], pa.int64(), mask=top[1] == 0)
                yield pa.RecordBatch.from_arrays([pa.array([q] * size, pa.int32()), pa.array([known.ids[q]] * size, pa.int64()), ids, pa.array(-top[0])],
                                                 ["item", "item_id", "doc_id", "score"])

    return blocks.mapInArrow(run, "item int, item_id long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """The k best documents (doc_id, text) of each item (item_id, text): item_id, rank, doc_id, score.

    Terms, weights and scores as in the module; equal scores by ascending
    doc_id, a null id first.  Null and termless texts have no terms: such
    documents are not counted, such items have no rows.  Each row of a
    repeated document is a document; a repeated row of an item counts once, and
    different texts of one item_id are ranked apart.  Further columns are
    ignored; empty tables give no rows."""
    spark, out = docs.sparkSession, []
    for asked in passes(items):
        path = scratch_path(spark, "lexical")
        counted(docs, asked.terms).write.parquet(f"{path}/counts")
        counts = spark.read.parquet(f"{path}/counts")
        total = counts.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
        if not total["docs"]:
            continue
        asked.weigh(total["docs"], document_frequencies(counts))
        index(counts, asked, total["docs"], total["terms"]).write.parquet(f"{path}/index")
        best_of_tasks = searched(spark.read.parquet(f"{path}/index"), asked, k)
        out.append(best_of_tasks.selectExpr("*", "row_number() over (partition by item order by score desc, doc_id) as rank").where(F.col("rank") <= k).select(
            "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    if not out:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    result = out[0]
    for more in out[1:]:
        result = result.union(more)
    return result


def op12_ranked_search(spark, sf_dir: str) -> DataFrame:
    """The 20 best of all ``documents`` for each ``benchmark`` item."""
    return ranked(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
