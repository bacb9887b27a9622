"""Toxicity of texts behind a noisy channel.

Writers hide words by look-alike characters (leetspeak), by spacing letters
out, and by repeating them.  Tokens that show any of this are read as a
lattice: each character may stand for itself, for the letters that it
resembles, or for nothing.  A Viterbi search finds the reading of least
channel cost and best probability under a character trigram model of the
corpus.  The restored words join the text's plain words, and both are scored
by a lexicon of words and word beginnings learnt from labelled texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage, read_table, remainder, text_of

#: Labelled rows that lexicon and weights are fitted on (a bounded sample by id hash).
SAMPLE = 30_000
#: A lexicon entry is so much more frequent in toxic texts of the sample than in others (natural log).
LEAST_ODDS = 1.5
MAX_ENTRIES = 20_000
PREFIXES = (4, 5, 6)
THRESHOLD = 0.3
STEP_CHARS = 250_000
#: Tokens whose words a worker remembers, and how long they may be.
MEMO, MEMO_CHARS = 300_000, 64
#: Ends of tokens whose readings a worker remembers.
END_CHARS = 4

#: What a character may stand for.
LOOKS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
         "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "%": "x",
         "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ѕ": "s", "ԁ": "d", "м": "m", "т": "t", "к": "k"}
SILENT = ".-_*~'`·,:;/#&​‌‍﻿­ "
LOOK_COST, SILENT_COST, REPEAT_COST, MASK_COST, END_COST = 1.0, 0.6, 0.3, 2.5, 3.0
VOWELS = "aeiou"

_LETTERS = re.compile(r"[^\W\d_]+")
_ODD = "".join(re.escape(c) for c in LOOKS)
_MARK = "".join(re.escape(c) for c in SILENT if c != " ")
_GAP = rf"[\s{_MARK}]"
#: What a token of at least three characters holds if it may be disguised: a look-alike next to a letter, marks between letters, or a letter twice in a row.
_HIDDEN = re.compile(rf"[^\W\d_][{_ODD}*]|[{_ODD}*][^\W\d_]|[^\W\d_][{_MARK}]+[^\W\d_]|([^\W\d_])\1")
#: Single or repeated characters apart from each other, with masks before and after them.
_SPACED = re.compile(rf"(?<![^\W_])([^\W_]|[{_ODD}])\1*+(?:{_GAP}++([^\W_]|[{_ODD}])\2*+(?![^\W_]))+")
_GAPS = re.compile(rf"{_GAP}++")
LEAST_SPACED = 4
#: What the inner two of four spaced characters look like: a text without it and without masks has no such run.
_FOUR = re.compile(rf"{_GAP}([^\W_]|[{_ODD}])\1*+{_GAP}++([^\W_]|[{_ODD}])\2*+{_GAP}")
#: Where a token may be read in more than one way: a character that is no letter or looks like one, or a letter twice in a row.
_BRANCH = re.compile(rf"[\W\d_{_ODD}]|([^\W\d_])\1")
#: Latin-1 bytes with a space for all but letters.
_SPACED_OUT = bytes(c if _LETTERS.match(chr(c)) else 32 for c in range(256))

#: Letters of the character model: word edge, any other letter, a to z, Latin-1.
_ALPHABET = "\0\1abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
_CODE = np.zeros(0x250, np.int64)
for _i in range(0x250):
    _CODE[_i] = max(0, _ALPHABET.find(chr(_i))) if _i > 1 and chr(_i) in _ALPHABET else (1 if chr(_i).isalpha() else 0)
_PLACE = {c: i for i, c in enumerate(_ALPHABET)}
_BITS = 6


def _codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _CODE[np.minimum(points, 0x24F)]
    codes[points >= 0x250] = 1
    return np.concatenate([[0, 0], codes, [0]])


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << (3 * _BITS), np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            for at in range(0, len(text), 1 << 20):  # windows overlap by the two characters before
                c = _codes(text[max(0, at - 2):at + (1 << 20)])
                c = c[2:] if at else c
                counts += np.bincount((c[:-2] << 2 * _BITS) | (c[1:-1] << _BITS) | c[2:], minlength=len(counts))
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["key", "n"])


class CharModel:
    """Interpolated trigram log probabilities of letters and word edges."""

    def __init__(self, rows: list[tuple[int, int]]):
        n = 1 << _BITS
        counts = np.zeros((n, n, n))
        for key, c in rows:
            counts[key >> 2 * _BITS, key >> _BITS & n - 1, key & n - 1] = c
        counts[0, 0, 0] = 0  # runs of marks and spaces
        two, one = counts.sum(0), counts.sum((0, 1))
        size = len(_ALPHABET)
        p1 = (one + 1) / (one.sum() + size)
        p2 = (two + 5 * p1) / (two.sum(1, keepdims=True) + 5)
        p3 = (counts + 5 * p2[None]) / (counts.sum(2, keepdims=True) + 5)
        self.log = np.log(p3).tolist()


@lru_cache(1 << 16)
def _options(before: str, c: str) -> tuple[tuple[str, float, int], ...]:
    """What a character may be read as after the one before, with its channel cost and letter code; a space ends a word."""
    if c.isalpha() and c not in LOOKS:
        options = [(c, 0.0)]
        if c in LOOKS.get(before, before):
            options.append(("", REPEAT_COST))
    elif c in LOOKS:
        options = [(x, LOOK_COST) for x in LOOKS[c]] + [(" ", END_COST)]
        if set(LOOKS[c]) & set(LOOKS.get(before, before)):
            options.append(("", REPEAT_COST))
        if c in "!|+(%$":
            options.append(("", 2 * SILENT_COST))
    elif c in SILENT or c.isspace():
        options = [("", SILENT_COST), (" ", END_COST)]
        if c == "*":
            options += [(v, MASK_COST) for v in VOWELS]
    else:
        options = [(" ", 0.5)]
    return tuple((out, cost, 0 if out == " " else _PLACE.get(out, 1)) for out, cost in options)


class Decoder:
    """Viterbi search through a token's lattice under the character model."""

    def __init__(self, log: list):
        self.log, self.memo, self.tokens, self.ends = log, {}, {}, {}

    def words(self, token: str) -> tuple[str, ...]:
        """Words of the most likely reading; only short tokens are remembered."""
        if len(token) > MEMO_CHARS:
            return tuple(_LETTERS.findall(self.restore(token)))
        if (known := self.memo.get(token)) is None:
            if len(self.memo) > MEMO:
                self.memo.clear()
            known = self.memo[token] = tuple(_LETTERS.findall(self.restore(token)))
        return known

    def of_token(self, token: str) -> tuple[str, ...]:
        """Words of a token without white space if it may be disguised; look into ``tokens`` first."""
        found = tuple(_LETTERS.findall(self.restore(token))) if len(token) > 2 and _HIDDEN.search(token) else ()
        if len(token) <= MEMO_CHARS:
            if len(self.tokens) > MEMO:
                self.tokens.clear()
            self.tokens[token] = found
        return found

    @staticmethod
    def _plain(token: str, at: int) -> str:
        """The letters from ``at`` on that stand for themselves."""
        m = _BRANCH.search(token, at)
        stretch = token[at:m.end() - 1] if m else token[at:]
        return stretch if stretch.isalpha() else token[at] if token[at].isalpha() and token[at] not in LOOKS else ""

    def restore(self, token: str) -> str:
        """The most likely reading of a token of any length; a path is its last letter and the path before it."""
        return self._read("", 0, 0, token)

    def _read(self, before: str, a: int, b: int, token: str) -> str:
        """The most likely reading of a token's rest after the character ``before`` and the last two letters ``a``, ``b``."""
        log, size, at, path = self.log, len(token), 0, None
        paths: dict[tuple[int, int], tuple[float, tuple | None]] = {}  # last two letters -> best score and its path, if several
        while at < size:
            char = token[at]
            if not paths:
                if char != before and (stretch := self._plain(token, at)):
                    path, at, before = (path, stretch), at + len(stretch), stretch[-1]
                    a, b = _PLACE.get(stretch[-2], 1) if len(stretch) > 1 else b, _PLACE.get(before, 1)
                    continue
                if at and size - at <= END_CHARS:
                    key = (before, a, b, token[at:])
                    if (known := self.ends.get(key)) is None:
                        if len(self.ends) > MEMO:
                            self.ends.clear()
                        known = self.ends[key] = self._read(*key)
                    path = (path, known)
                    break
                if at and char == before and a != b == _PLACE.get(char, 1) and at + 1 < size:  # a letter twice, then another one
                    if (after := token[at + 1]) != char and after.isalpha() and char not in LOOKS and after not in LOOKS:
                        c = _PLACE.get(after, 1)
                        once = log[a][b][c] - REPEAT_COST > log[a][b][b] + log[b][b][c]
                        path, a, b, at, before = (path, after if once else char + after), b, c, at + 2, after
                        continue
                paths = {(a, b): (0.0, path)}
            options, at, before = _options(before, char), at + 1, char
            nxt: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (score, path) in paths.items():
                for out, cost, c in options:
                    if out == "":
                        key, s, p = (a, b), score - cost, path
                    elif c == 0 and b == 0:
                        key, s, p = (0, 0), score - cost, path
                    else:
                        key, s, p = (b, c), score - cost + log[a][b][c], (path, out)
                    old = nxt.get(key)
                    if old is None or s > old[0]:
                        nxt[key] = (s, p)
            paths = nxt
            if len(paths) == 1:
                ((a, b), (_, path)), = paths.items()
                paths = {}
        if paths:
            path = max(((s + (log[a][b][0] if b else 0.0), a, b, p) for (a, b), (s, p) in paths.items()), key=lambda x: x[:3])[3]
        read = []
        while path is not None:
            path, out = path
            read.append(out)
        return "".join(reversed(read))


def _spaced(text: str) -> Iterator[str]:
    """Runs of at least four characters or masks apart from each other, with the masks around them."""
    at = 0
    if "*" not in text and not _FOUR.search(text):
        return
    for m in _SPACED.finditer(text):
        start, end = m.span()
        before = start
        while before > at and (text[before - 1] in SILENT or text[before - 1].isspace()):
            before -= 1
        if (star := text.find("*", before, start)) >= 0:
            start = star
        if after := _GAPS.match(text, end):
            end = max(end, text.rfind("*", end, after.end()) + 1)
        at = end
        token = text[start:end]
        if len(_GAPS.findall(m.group(0))) + 1 + token.count("*") >= LEAST_SPACED:
            yield token


def hidden_words(text: str, decoder: Decoder) -> set[str]:
    """Words of the most likely readings of a lower-case text's disguised tokens."""
    found: set[str] = set()
    known = decoder.tokens
    for token in set(text.split()):
        words = known.get(token)
        if words is None:
            words = decoder.of_token(token)
        if words:
            found.update(words)
    for token in set(_spaced(text)):
        found.update(decoder.words(token))
    return found


def words_of(text: str) -> set[str]:
    """Distinct words of a text."""
    try:
        return set(text.encode("latin-1").translate(_SPACED_OUT).decode("latin-1").split())
    except UnicodeEncodeError:
        return set(_LETTERS.findall(text))


def features(text: str, decoder: Decoder) -> set[str]:
    """Words, plain and restored, and their beginnings (marked by a star) of a text."""
    low = text.lower()
    words = words_of(low) | hidden_words(low, decoder)
    out = set(words)
    for n in PREFIXES:
        out.update([w[:n] + "*" for w in words if len(w) > n])
    return out


class Lexicon:
    """Features with their numbers of toxic and other texts in the sample.

    A feature counts if its split between the classes is less likely to be
    chance than one in the number of features looked at (log likelihood ratio
    against the class sizes)."""

    def __init__(self, rows: list[tuple[str, int, int]], toxic: int, other: int, tested: int):
        self.toxic, self.other = toxic, other
        self.least = max(6.0, float(np.log(max(1, tested))) - 2)
        self.counts = {f: (a, b) for f, a, b in rows}
        self.known = {f: w for f, (a, b) in self.counts.items() if (w := self.odds(a, b)) > 0}
        self.words = {f for f in self.known if not f.endswith("*")}
        self.prefixes = {n: {f[:n] for f in self.known if f.endswith("*") and len(f) == n + 1} for n in PREFIXES}
        self.heads = {f[:min(PREFIXES)] for known in self.prefixes.values() for f in known}

    def odds(self, a: int, b: int, less_a: int = 0, less_b: int = 0) -> float:
        """Log odds of a feature in toxic texts; 0 if they may be chance.  ``less``: texts to leave out."""
        a, b, toxic, other = a - less_a, b - less_b, self.toxic - less_a, self.other - less_b
        if a < 2 or toxic < 1 or other < 1:
            return 0.0
        share = toxic / (toxic + other)
        ratio = a * np.log(a / ((a + b) * share)) + (b * np.log(b / ((a + b) * (1 - share))) if b else 0.0)
        odds = float(np.log((a + 0.5) / (toxic + 1)) - np.log((b + 0.5) / (other + 1)))
        return odds if odds >= LEAST_ODDS and ratio >= self.least else 0.0


class Scorer:
    """Probability that a text is marked toxic."""

    def __init__(self, log: list, lexicon: Lexicon | None, weights: list[float] | None):
        self.log, self.lexicon, self.weights = log, lexicon, weights
        self.decoder = Decoder(log)

    def hits(self, text: str, own: int | None = None) -> list[float]:
        """Summary of a text: 1, distinct toxic words, their summed and greatest odds, log length.

        ``own``: the text's label if it is one of the sample; its own part in the lexicon is then left out."""
        low, lexicon = text.lower(), self.lexicon
        words = words_of(low)
        if extra := hidden_words(low, self.decoder):
            words |= extra
        found: dict[str, list[str]] = {w: [w] for w in words & lexicon.words}
        head, heads = min(PREFIXES), lexicon.heads
        begun = [w for w in words if w[:head] in heads]
        for n, known in lexicon.prefixes.items():
            if known:
                for w in begun:
                    if w[:n] in known and len(w) > n:
                        found.setdefault(w, []).append(w[:n] + "*")
        if own is None:
            odds = [max(lexicon.known[f] for f in fs) for fs in found.values()]
        else:
            odds = [max(lexicon.odds(*lexicon.counts[f], own, 1 - own) for f in fs) for fs in found.values()]
        odds = [x for x in odds if x > 0]
        return [1.0, float(np.log1p(len(odds))), float(np.log1p(sum(odds))), max(odds, default=0.0), float(np.log1p(len(words)))]

    def score(self, text: str) -> float:
        if self.weights is None:
            return 0.0
        x = self.hits(text)
        return float(1 / (1 + np.exp(-np.clip(np.dot(self.weights, x), -30, 30)))) if x[-1] else 0.0


def _feature_counts(shared):
    def run(batches):
        decoder = Decoder(shared.value)
        for batch in batches:
            counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, toxic in zip(*(c.to_pylist() for c in batch.columns)):
                counts[toxic].update(features(text, decoder))
            for toxic, c in counts.items():
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array([toxic] * len(c), pa.int32()),
                                                  pa.array(list(c.values()), pa.int64())], ["feature", "toxic", "n"])
    return run


def _summaries(shared):
    def run(batches):
        scorer = Scorer(*shared.value)
        for batch in batches:
            texts, toxic = (c.to_pylist() for c in batch.columns)
            x = [scorer.hits(t, y) for t, y in zip(texts, toxic)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1)], ["x", "toxic"])
    return run


def _fit(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> list[float]:
    """Logistic regression by Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + penalty * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def char_model(docs: DataFrame) -> CharModel:
    """Character model of all texts; what is gathered is bounded by the alphabet."""
    rows = docs.select(text_of().alias("text")).mapInArrow(_trigrams, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).collect()
    return CharModel([tuple(r) for r in rows])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Scorer:
    """Fit on the texts of ``docs`` (doc_id, text) and on about ``sample`` rows of ``labels`` (doc_id, toxic 0 or 1).

    A text of the sample is summarised for the weights as if it were not in
    the lexicon.  Labels with nulls or without a text are left out; without
    both classes every score is 0."""
    spark = docs.sparkSession
    log = char_model(docs).log
    marked = labels.where("doc_id is not null and toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    total = marked.count()
    drawn = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < min(1.0, sample / max(1, total)) * (1 << 30))
    texts = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(drawn), "doc_id")  # bounded by the sample
    texts = cut_lineage(texts.select("text", "toxic"))
    sizes = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return Scorer(log, None, None)
    counts = cut_lineage(texts.mapInArrow(
        _feature_counts(spark.sparkContext.broadcast(log)), "feature string, toxic int, n long").groupBy("feature").agg(
        F.sum(F.col("n") * F.col("toxic")).alias("a"), F.sum(F.col("n") * (1 - F.col("toxic"))).alias("b")).where("a >= 2"))
    entries = counts.where(F.col("a") * sizes[0] > 3 * F.col("b") * sizes[1]).orderBy(
        F.desc(F.log((F.col("a") + 0.5) / (F.col("b") + 0.5)) * F.col("a")), "feature").limit(MAX_ENTRIES).collect()
    lexicon = Lexicon([tuple(r) for r in entries], sizes[1], sizes[0], counts.count())
    fitted = spark.sparkContext.broadcast((log, lexicon, None))
    rest = texts.mapInArrow(_summaries(fitted), "x array<double>, toxic int").collect()
    weights = _fit(np.array([r["x"] for r in rest]), np.array([r["toxic"] for r in rest], float))
    return Scorer(log, lexicon, weights)


def _score(shared):
    def run(batches):
        if not hasattr(shared, "scorer"):
            shared.scorer = Scorer(*shared.value)
        for batch in batches:
            scores = [shared.scorer.score(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(scores, pa.float64())], [*batch.schema.names[1:], "score"])
    return run


def scored(docs: DataFrame, scorer: Scorer, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of every row with score and predicted (score >= 0.3); only ``text`` is looked at.

    Null and empty texts and those without a word score 0; whole texts are read;
    repeated rows are each scored; other columns are ignored; an empty table
    gives an empty result."""
    shared = docs.sparkSession.sparkContext.broadcast((scorer.log, scorer.lexicon, scorer.weights))
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField("score", T.DoubleType())])
    out = docs.select(text_of().alias("__text"), *keep).mapInArrow(_score(shared), schema)
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of all ``documents``; rows with crc32 of the id = 2 modulo 4 are not learnt from."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    scorer = train(docs.where(remainder("doc_id", 4) != 2), labels.where(remainder("doc_id", 4) != 2))
    marked = docs.select("doc_id", "text", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"))
    return scored(marked, scorer, ["doc_id", "held_out"]).select("doc_id", "held_out", "score", "predicted")
