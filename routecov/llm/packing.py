"""Cost-balanced packing of documents into sequences of bounded length.

Tokens: no merge, match or special token of the vocabulary spans white space,
so the ids of a text are those of its space-separated chunks in a row.  Chunks
are numbered by Arrow's dictionary coding; those met lately are kept per worker
and only new ones go through the library.

Packing: whole blocks of a document's ids fill sequences of their own.  What
is left is dealt into groups of bounded size; in each, as many sequences as
its tokens need are opened, and the remainders, longest first, go to the
sequence of lowest estimated cost (linear plus quadratic in a piece's length)
that still has room.  A remainder that fits nowhere whole is cut at the
sequence with most room.  A group thus leaves less than one sequence of
padding in all.
"""

from __future__ import annotations

import gc
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_rows, read_table, text_of

#: Bytes of text whose remainders are packed together.
GROUP_BYTES = 16 << 20
#: Cost of one token's attention to one other, relative to a token's linear layers (width 4,096).
QUADRATIC = 1 / 24_576
MAX_CHUNKS = 250_000
#: Characters encoded in one go, words whose ids are put in place in one go, and ids handed on in one go.
STEP_CHARS, STEP_WORDS, STEP_IDS = 2_000_000, 1 << 18, 1 << 20

#: White_Space of Unicode.  str.split() also splits at 1C to 1F, which the tokenizer does not.
_SPACES = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_ONLY_PYTHON = re.compile("[\x1c-\x1f]")
# The patterns below are RE2's.
_MARKS = "".join(rf"\x{{{c:02x}}}" for c in range(256) if re.match(r"[^\w\s]", chr(c)))
#: Text that is not Latin-1 or may hold a special token ("<").
_NOT_LATIN = r"[^\x{00}-\x{ff}]|[<\x1c-\x1f]"
#: Marks that stand together make one token, an apostrophe may start a contraction.
_TOGETHER = rf"['_]|[{_MARKS}][{_MARKS}]"
#: A lower-case word of Latin letters, and one with closing marks, which stand apart from the letters before them.
_LOWER = r"[a-z\x{df}-\x{f6}\x{f8}-\x{ff}]"
_TAIL = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in "'<")
_CLOSED = rf"({_LOWER})([{''.join(rf'\x{ord(c):02x}' for c in _TAIL)}]+\s)"
_ENCODERS: dict[str, Encoder] = {}


def _strings(col: pa.Array) -> list[str]:
    return col.to_numpy(zero_copy_only=False).tolist()  # much faster than to_pylist


def parted(texts: pa.Array) -> list[str]:
    """Texts with ASCII white space between parts that the tokenizer encodes independently of each other.

    White space always parts.  In Latin-1 text, which composing leaves as it
    is, lower case changes nothing, and marks that close a word part; single
    stops and commas part anywhere."""
    out, closed = [], []
    other, together = (pc.match_substring_regex(texts, p).to_numpy(zero_copy_only=False).tolist() for p in (_NOT_LATIN, _TOGETHER))
    for text, foreign, marks in zip(texts.to_pylist(), other, together):
        if foreign:
            out.append(" ".join(_SPACES.split(text) if _ONLY_PYTHON.search(text) else text.split()))
            continue
        text = text.lower().replace("\xa0", " ").replace("\x85", " ")
        if marks:
            closed.append(len(out))
            out.append(text + " ")
        else:
            out.append(text.replace(".", " . ").replace(",", " , "))
    if closed:
        for i, text in zip(closed, _strings(pc.replace_substring_regex(pa.array([out[i] for i in closed], pa.large_string()), _CLOSED, r"\1 \2"))):
            out[i] = text
    return out


def _gather(table: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``table`` in a row, and their bounds there."""
    ends = np.zeros(len(first) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    out = np.empty(ends[-1], table.dtype)
    for a in range(0, len(first), STEP_WORDS):
        at = ends[a:a + STEP_WORDS + 1]
        out[at[0]:at[-1]] = table[np.repeat(first[a:a + STEP_WORDS] - at[:-1], sizes[a:a + STEP_WORDS]) + np.arange(at[0], at[-1])]
    return out, ends


class Encoder:
    """Ids of texts.

    Parts met lately are kept as one Arrow column, with the place of their ids
    in one table.  Lower-case words of Latin letters are encoded many as one
    text, by the same merges but without the normaliser and pattern, which
    leave them as they are; the ids that close a word tell them apart.  Other
    such words with closing marks go by their lower-case word."""

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.tokenizer, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closing[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.known = pa.array([], pa.large_string())
        self.table, self.first, self.sizes = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of lower-case words of Latin letters, and how many each has."""
        lines = [" ".join(_strings(words.slice(i, 2000))) for i in range(0, len(words), 2000)]
        encoded = self.plain.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.concatenate([np.zeros(0, "<u4"), *(np.array(e.ids, "<u4") for e in encoded)])
        sizes = np.diff(np.flatnonzero(self.closing[ids]), prepend=-1)
        if len(sizes) != len(words):
            raise ValueError("the vocabulary does not close every word")
        return ids, sizes

    def _library(self, chunks: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    def _learn(self, fresh: pa.Array) -> None:
        """Append the ids of parts to the table."""
        lower = pc.match_substring_regex(fresh, f"^{_LOWER}+$")
        others = _strings(fresh.filter(pc.invert(lower)))
        cores = [w.rstrip(_TAIL) for w in others]
        cores = [c.lower() if c.isalpha() and (c.isascii() or max(c) <= "\xff") else "" for c in cores]
        ids, sizes = self._words(pa.concat_arrays([fresh.filter(lower), pa.array([c for c in cores if c], pa.large_string())]))
        first = np.cumsum(sizes) - sizes
        n = pc.sum(lower).as_py() or 0
        tails = [w[len(c):] if c else w for w, c in zip(others, cores)]
        distinct = list(set(tails))
        of_tail = dict(zip(distinct, self._library(distinct)))
        ends = iter(np.split(ids, first[n:])[1:])
        rest = [np.concatenate([next(ends), of_tail[t]]) if c else of_tail[t] for t, c in zip(tails, cores)]
        plain, mask = len(ids) - sizes[n:].sum(), lower.to_numpy(zero_copy_only=False)
        more = np.fromiter(map(len, rest), np.int64, len(rest))
        at, size = np.empty(len(fresh), np.int64), np.empty(len(fresh), np.int64)
        at[mask], size[mask] = first[:n], sizes[:n]
        at[~mask], size[~mask] = plain + np.cumsum(more) - more, more
        self.first, self.sizes = np.concatenate([self.first, at + len(self.table)]), np.concatenate([self.sizes, size])
        self.table = np.concatenate([self.table, ids[:plain], *rest])

    def _forget(self, used: np.ndarray) -> None:
        """Keep only the parts used last, not more than there may be."""
        self.known = self.known.take(pa.array(used := np.unique(used)[:MAX_CHUNKS // 2]))
        self.table, ends = _gather(self.table, self.first[used], self.sizes[used])
        self.first, self.sizes = ends[:-1], np.diff(ends)

    def ids(self, texts: pa.Array, stop: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each text's closed by ``stop`` if given, and the texts' bounds in them."""
        parts = pc.ascii_split_whitespace(pa.array(parted(texts), pa.large_string()))
        bounds, n = parts.offsets.to_numpy().astype(np.int64), len(self.known)
        coded = pa.concat_arrays([self.known, parts.values]).dictionary_encode()  # the known parts keep their numbers
        self._learn(coded.dictionary.slice(n))
        self.known, index = coded.dictionary, coded.indices.to_numpy()[n:]
        table, first, sizes = self.table, self.first, self.sizes
        if len(self.known) > MAX_CHUNKS:
            self._forget(index)
        if stop is not None:
            index = np.insert(index, bounds[1:], len(first))
            bounds += np.arange(len(bounds))
            first, sizes, table = np.append(first, len(table)), np.append(sizes, 1), np.append(table, np.uint32(stop))
        ids, ends = _gather(table, first[index], sizes[index])
        return ids, ends[bounds]

    def encode(self, texts: list[str]) -> list[bytes]:
        ids, bounds = self.ids(pa.array(texts, pa.large_string()))
        return [ids[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


_PIECES = pa.schema([("pack", pa.int64()), ("doc_id", pa.int64()), ("no_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                     ("doc_tokens", pa.int64()), ("ids", pa.binary())])


def _pieces(path: str, size: int, end: int):
    """Blocks of ``size`` ids and each document's remainder."""
    def pieces(tokens: Encoder, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, columns = batch.column(2), [batch.column(c).to_numpy() for c in (0, 1, 3)]
        chars = np.concatenate([[0], np.cumsum(pc.utf8_length(texts).to_numpy(), dtype=np.int64)])
        i = 0
        while i < len(texts):
            j = min(len(texts), max(i + 1, int(np.searchsorted(chars, chars[i] + STEP_CHARS))))
            ids, bounds = tokens.ids(texts.slice(i, j - i), end)
            blocks = -(-np.diff(bounds) // size)
            row = np.repeat(np.arange(j - i), blocks)
            start = size * (np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks))
            edge = np.append(bounds[row] + start, bounds[-1])  # pieces follow each other without gaps
            a = 0
            while a < len(row):
                b = max(a + 1, int(np.searchsorted(edge, edge[a] + STEP_IDS, "right")) - 1)
                r, part = row[a:b], ids[edge[a]:edge[b]]
                data = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer((4 * (edge[a:b + 1] - edge[a])).astype(np.int32)), pa.py_buffer(part)])
                yield pa.RecordBatch.from_arrays([*(pa.array(c[i + r]) for c in columns), pa.array(start[a:b]), pa.array(np.diff(edge[a:b + 1])),
                                                  pa.array(np.diff(bounds)[r]), data], schema=_PIECES)
                a = b
            i = j

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path)
        gc.disable()  # millions of short-lived lists and tuples, none in cycles
        try:
            for batch in batches:
                yield from pieces(tokens, batch)
        finally:
            gc.enable()
            pa.default_memory_pool().release_unused()
    return run


def assign(lengths: list[int], size: int, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """Pack pieces of at most ``size`` tokens: (piece, start within it, length, sequence, offset there)."""
    n = -(-sum(lengths) // size)
    room, cost = [size] * n, [0.0] * n
    light = [(0.0, s) for s in range(n)]  # sequences that may have room for the next piece, by cost
    tight: list[tuple[int, int]] = []  # those that had too little, by room
    todo = [(-length, i, 0) for i, length in enumerate(lengths) if length]
    heapq.heapify(todo)
    placed = []

    def put(i: int, at: int, length: int, s: int) -> None:
        placed.append((i, at, length, s, size - room[s]))
        room[s] -= length
        cost[s] += length + quadratic * length * length

    while todo:
        length, i, at = heapq.heappop(todo)
        length = -length
        while tight and -tight[0][0] >= length:
            s = heapq.heappop(tight)[1]
            heapq.heappush(light, (cost[s], s))
        while light and room[light[0][1]] < length:
            s = heapq.heappop(light)[1]
            if room[s]:
                heapq.heappush(tight, (-room[s], s))
        if light:
            s = heapq.heappop(light)[1]
            put(i, at, length, s)
            heapq.heappush(light, (cost[s], s))
        else:
            s = heapq.heappop(tight)[1]
            part = room[s]
            put(i, at, part, s)
            heapq.heappush(todo, (part - length, i, at + part))
    return placed


_PACKED = pa.schema([("doc_id", pa.int64()), ("no_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
                     ("ids", pa.binary()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def _pack(size: int, quadratic: float):
    def run(rows: pa.Table) -> pa.Table:
        doc, no_id, start, length, tokens = (rows[c].to_numpy() for c in ("doc_id", "no_id", "start", "length", "doc_tokens"))
        order = np.lexsort((length, start, no_id, doc))
        full, part = order[length[order] == size], order[length[order] != size]
        placed = np.array(assign(length[part].tolist(), size, quadratic), np.int64).reshape(-1, 5)
        none, base = np.zeros(len(full), np.int64), rows["pack"][0].as_py() << 32
        i, at, n = (np.concatenate(x) for x in ((full, part[placed[:, 0]]), (none, placed[:, 1]), (length[full], placed[:, 2])))
        data, offsets = binary_rows(pa.concat_arrays(rows["ids"].chunks))
        low, view = offsets[i] + 4 * at, memoryview(data)
        ids = b"".join([view[a:b] for a, b in zip(low.tolist(), (low + 4 * n).tolist())])
        ends = np.concatenate([[0], np.cumsum(4 * n)]).astype(np.int32)
        return pa.Table.from_arrays(
            [*(pa.array(x) for x in (doc[i], no_id[i], start[i] + at, n, tokens[i])),
             pa.Array.from_buffers(pa.binary(), len(i), [None, pa.py_buffer(ends), pa.py_buffer(ids)]),
             pa.array(base + np.concatenate([np.arange(len(full)), len(full) + placed[:, 3]])), pa.array(np.concatenate([none, placed[:, 4]]))],
            schema=_PACKED)
    return run


def packed(docs: DataFrame, tokenizer: str, size: int = 2048, end: int = 1, quadratic: float = QUADRATIC,
           group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Pieces of all documents in sequences of at most ``size`` tokens.

    Per piece: doc_id, start (ids of its document before it), length, ids
    (little-endian unsigned 32 bit), ids_crc32 (of these bytes), doc_tokens
    (with the closing id ``end``), sequence_id, offset.  A null or empty text is the
    closing id alone; repeated rows are packed each; a null doc_id is carried;
    other columns are ignored; an empty table gives no pieces.
    """
    texts = docs.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().cast("long").alias("no_id"), text_of().alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    packs = max(1, -(-total // group_bytes))
    rows = texts.select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(packs)).alias("pack"), "doc_id", "text", "no_id")
    pieces = rows.mapInArrow(_pieces(tokenizer, size, end), "pack long, doc_id long, no_id long, start long, length long, doc_tokens long, ids binary")
    return pieces.groupBy("pack").applyInArrow(
        _pack(size, quadratic),
        "doc_id long, no_id long, start long, length long, doc_tokens long, ids binary, sequence_id long, offset long").select(
        F.when(F.col("no_id") == 0, F.col("doc_id")).alias("doc_id"), "start", "length", "ids", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset")


def op5_packing(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of 2,048 tokens."""
    import public_tokenizers
    return packed(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).drop("ids")
