"""Token counts of whole texts by a compiled sentencepiece byte-pair model."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, read_table, text_of
from .transducer import SPACE, Counter, Map, Transducer

#: Characters of a chunk; longer texts are counted chunk by chunk on all executors.
CHUNK = 1 << 16
_COUNTERS: dict[str, Counter] = {}


def counter(model: str) -> Counter:
    """The compiled model, once for each worker process."""
    if model not in _COUNTERS:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        ids = [i for i in range(sp.get_piece_size())
               if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        _COUNTERS[model] = Counter(Transducer({sp.id_to_piece(i): sp.get_score(i) for i in ids}))
    return _COUNTERS[model]


def normalised(text: str) -> str:
    """The model's view of a text: spaces as U+2581, one in front."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def _first_pass(model: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(model)
        for batch in batches:
            rows, pieces, nos, tokens = [], [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                text = normalised(text)
                if len(text) <= size:
                    rows.append(i), pieces.append(None), nos.append(0), tokens.append(count.between(text))
                else:
                    for no, at in enumerate(range(0, len(text), size)):
                        rows.append(i), pieces.append(text[at:at + size]), nos.append(no), tokens.append(None)
            head = batch.select(["row", "doc_id", "n_bytes"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*head.columns, pa.array(pieces, pa.string()), pa.array(nos, pa.int64()), pa.array(tokens, pa.int64())],
                ["row", "doc_id", "n_bytes", "piece", "no", "n_tokens"])
    return run


def _maps(model: str):
    def run(batches):
        count = counter(model)
        for batch in batches:
            maps = [count.chunk(x) for x in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array([m.head for m in maps]), pa.array([m.body for m in maps], pa.int64()),
                 pa.array([m.tail for m in maps], pa.string())], ["row", "doc_id", "n_bytes", "no", "head", "body", "tail"])
    return run


def _joined(model: str):
    def run(rows):
        import pandas as pd
        count = counter(model)
        rows = rows.sort_values("no")
        maps = [Map(h, int(b), None if pd.isna(t) else t) for h, b, t in zip(rows["head"], rows["body"], rows["tail"])]
        out = rows[["doc_id", "n_bytes"]].head(1).copy()
        out["n_tokens"] = count.finish(count.scan(maps)[-1])
        return out
    return run


def token_counts(docs: DataFrame, model: str, limit: int = 4096, chunk: int = CHUNK) -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Counts equal the library's encoding without added tokens.  Null and empty
    texts have no bytes and no tokens; repeated rows and null ids are counted
    each; other columns are ignored; an empty table gives an empty result.
    A text over ``chunk`` characters is cut into chunks that are counted apart
    and joined by their state maps; a chunk's map is a few words, so joining
    the maps of one text (2 GB at most) is small.
    """
    texts = docs.select("doc_id", text_of().alias("text")).select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"))
    first = cut_lineage(texts.select("row", "doc_id", "text", "n_bytes").mapInArrow(
        _first_pass(model, chunk), "row long, doc_id long, n_bytes long, piece string, no long, n_tokens long"))
    short = first.where("piece is null").select("doc_id", "n_bytes", "n_tokens")
    pieces = first.where("piece is not null").repartition("row", "no").select("row", "doc_id", "n_bytes", "no", "piece")
    maps = pieces.mapInArrow(_maps(model), "row long, doc_id long, n_bytes long, no long, head string, body long, tail string")
    long = maps.groupBy("row").applyInPandas(_joined(model), "doc_id long, n_bytes long, n_tokens long")
    return short.union(long).withColumn("over_limit", F.col("n_tokens") > limit)


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    """Tokens of every document by the 32,000-piece model."""
    import public_tokenizers
    return token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
