"""Language identification by words, backing off to character n-grams.

The model holds, for each language, the relative frequency of its words and
of the character n-grams in them.  A known word scores by its negative
log frequency in each language (a fixed penalty where a language lacks it).
An unseen word scores by the mean of its longest n-grams of which any is
known, falling back from five characters to one.  A text has the language of
the least mean over its words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read_table, remainder

#: Labelled rows that the model is fitted on, for each language (a bounded sample by id hash).
SAMPLE = 1_500
#: Words, and n-grams of each length, kept for each language.
WORDS, GRAMS = 20_000, 6_000
LONGEST = 5
MAX_LANGUAGES = 1_000
#: Cost (negative log10 frequency) of what a language has not.
PENALTY = 7.0
UNKNOWN = "und"
MEMO = 150_000
STEP_CHARS = 250_000
_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    word = f" {word} "
    return [word[i:i + n] for i in range(len(word) - n + 1)] if len(word) >= n else []


def _steps(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about ``STEP_CHARS`` characters in column ``text``, so that no whole batch is held as Python objects."""
    ends, i = np.cumsum(pc.fill_null(pc.utf8_length(batch.column(text)), 0).to_numpy(zero_copy_only=False), dtype=np.int64), 0
    while i < len(ends):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + STEP_CHARS, "right")))
        yield batch.slice(i, j - i)
        i = j


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (step for whole in batches for step in _steps(whole, 1)):
        by: dict[str, Counter] = {}
        for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
            by.setdefault(lang, Counter()).update(words_of(text))
        for lang, words in by.items():
            grams: list[Counter] = [words, *(Counter() for _ in range(LONGEST))]
            for w, c in words.items():
                for n in range(1, LONGEST + 1):
                    for g in grams_of(w, n):
                        grams[n][g] += c
            for n, counted in enumerate(grams):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counted), pa.string()), pa.array([n] * len(counted), pa.int32()),
                     pa.array(list(counted), pa.string()), pa.array(list(counted.values()), pa.int64())], ["lang", "n", "gram", "c"])


class Model:
    """Costs of words and n-grams by language."""

    def __init__(self, languages: list[str], rows: Iterable[tuple[str, int, str, int]]):
        """rows: (language, length or 0 for a word, text, count), in any order."""
        self.languages = languages
        totals = np.zeros((LONGEST + 1, len(languages)))
        place = {lang: i for i, lang in enumerate(languages)}
        ids: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
        cells = []
        size = 0
        for lang, n, gram, c in rows:
            i = ids[n].get(gram)
            if i is None:
                i = ids[n][gram] = size
                size += 1
            cells.append((i, place[lang], n, c))
            totals[n, place[lang]] += c
        self.cost = np.full((size, len(languages)), PENALTY, np.float32)
        for i, j, n, c in cells:
            self.cost[i, j] = min(PENALTY, -np.log10(c / totals[n, j]))
        self.ids = ids
        self.neutral = np.full(len(languages), PENALTY, np.float32)

    def word_cost(self, word: str) -> np.ndarray:
        if (i := self.ids[0].get(word)) is not None:
            return self.cost[i]
        for n in range(LONGEST, 0, -1):
            get = self.ids[n].get
            known = [i for g in grams_of(word, n) if (i := get(g)) is not None]
            if known:
                return self.cost[known].mean(0)
        return self.neutral


class Scorer:
    """Scores texts; costs of words met lately are kept."""

    def __init__(self, model: Model):
        self.model = model
        self._reset()

    def _reset(self) -> None:
        self.place: dict[str, int] = {}
        self.costs = np.zeros((4096, len(self.model.languages)), np.float32)

    def _learn(self, fresh: list[str]) -> None:
        n = len(self.place)
        need = n + len(fresh)
        if need > len(self.costs):
            self.costs = np.concatenate([self.costs, np.zeros((need + need // 2 - len(self.costs), self.costs.shape[1]), np.float32)])
        for i, w in enumerate(fresh, n):
            self.costs[i] = self.model.word_cost(w)
            self.place[w] = i

    def score(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if len(self.place) > MEMO:
            self._reset()
        counted = [Counter(words_of(t)) if t else {} for t in texts]
        fresh: set[str] = set()
        for c in counted:
            fresh.update(c)
        self._learn([w for w in fresh if w not in self.place])
        out = []
        for c in counted:
            if not c or not self.model.languages:
                out.append((UNKNOWN, 0.0))
                continue
            weight = np.fromiter(c.values(), np.float64, len(c))
            cost = weight @ self.costs[np.fromiter(map(self.place.__getitem__, c), np.int64, len(c))] / weight.sum()
            evidence = np.exp(-np.log(10) * np.sqrt(weight.sum()) * (cost - cost.min()))
            best = int(cost.argmin())
            out.append((self.model.languages[best], float(evidence[best] / evidence.sum())))
        return out


def train(docs: DataFrame, sample: int = SAMPLE, words: int = WORDS, grams: int = GRAMS) -> Model:
    """Fit on at most about ``sample`` rows of each non-null ``lang`` (doc_id, text, lang)."""
    labelled = docs.where("lang is not null and text is not null and doc_id is not null")
    classes = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    if not classes:
        return Model([], [])
    share = F.create_map(*[F.lit(x) for r in classes for x in (r["lang"], min(1.0, sample / r["count"]))])
    drawn = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.element_at(share, F.col("lang")) * (1 << 30))
    counts = drawn.select("lang", "text").mapInArrow(_counts, "lang string, n int, gram string, c long").groupBy("lang", "n", "gram").agg(
        F.sum("c").alias("c"))
    rank = F.row_number().over(Window.partitionBy("lang", "n").orderBy(F.desc("c"), "gram"))
    kept = counts.withColumn("rank", rank).where(F.col("rank") <= F.when(F.col("n") == 0, words).otherwise(grams))
    counted = kept.select("lang", "n", "gram", "c").toArrow()  # columns, so the driver makes no row objects of all of it
    rows = (r for part in counted.to_batches(10_000) for r in zip(*(c.to_pylist() for c in part.columns)))
    return Model(sorted(r["lang"] for r in classes), rows)


def _predict(shared, names: tuple[str, str], text: int, kept: list[int]):
    """``text``: place of the text in a row; ``kept``: places of the columns handed on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not hasattr(shared, "scorer"):
            shared.scorer = Scorer(shared.value)
        for batch in batches:
            for step in _steps(batch, text):
                out = shared.scorer.score(step.column(text).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(step.column(i) for i in kept), pa.array([x for x, _ in out], pa.string()), pa.array([x for _, x in out], pa.float64())],
                    [*(step.schema.names[i] for i in kept), *names])
        pa.default_memory_pool().release_unused()
    return run


def predicted(docs: DataFrame, model: Model, keep: list[str], names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Columns ``keep`` of every row with language and score as ``names``; only ``text`` is looked at.

    A null text, or one without a letter, is ``und`` with score 0, as is any
    text if there was nothing to learn from.  Whole texts are read; repeated
    rows are each scored; other columns are ignored.  The model is broadcast:
    its size is bounded by languages, words and n-grams kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*(docs.schema[c] for c in keep), T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    if "text" in keep:  # sent to Python once
        return docs.select(*keep).mapInArrow(_predict(shared, names, keep.index("text"), list(range(len(keep)))), schema)
    return docs.select(F.col("text").alias("__text"), *keep).mapInArrow(_predict(shared, names, 0, list(range(1, len(keep) + 1))), schema)


def op1_language(spark, sf_dir: str) -> DataFrame:
    """Languages of all ``documents``; rows with crc32 of the id = 1 modulo 3 are not learnt from."""
    docs = read_table(spark, sf_dir, "documents")
    model = train(docs.where(remainder("doc_id", 3) != 1))
    marked = docs.select("doc_id", "text", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"))
    return predicted(marked, model, ["doc_id", "held_out"])
