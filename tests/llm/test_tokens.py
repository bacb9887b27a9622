"""Token counts and ids against the libraries; packing laws."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from corpus_frames import frame  # noqa: F401 - a fixture
from routecov.llm import packing
from routecov.llm.token_counts import counter, normalised, token_counts

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "B", " ", "  ", "\n", "the", "ing", "é", "É", "ß", "😀", "日本", "\t", "<s>", "</s>", "▁", "0", "12", "²", "'s", "'LL", "!!", "-----", "===",
         "\x00", "\x1c", "\x1f", "\x85", "\xa0", "　", "​", "한", "̀", "İ", "Σ", "<|endoftext|>", ".", ",", "b,", "c.D", " THE. ", "_", "ª", "unbelievable"]


def texts(n, seed=3):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def test_transducer_equals_sentencepiece():
    import sentencepiece
    sp, count = sentencepiece.SentencePieceProcessor(model_file=PIECES), counter(PIECES)
    for text in texts(4000):
        want, view = len(sp.encode(text)), normalised(text)
        assert count.between(view) == want, repr(text)
        maps = [count.chunk(view[i:i + 5]) for i in range(0, len(view), 5)]
        assert not maps or count.finish(count.scan(maps)[-1]) == want, repr(text)


def test_token_counts_rows(frame):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = [(1, None), (2, ""), (3, "the the"), (3, "the the"), (None, "x"), (4, "Ünbe\nkannt " * 9000), (5, "a" * 70_000)]
    rows += [(10 + i, t.replace("\x00", "")) for i, t in enumerate(texts(60, 8))]
    got = sorted([tuple(r) for r in token_counts(frame(rows), PIECES, chunk=1000).collect()], key=str)
    want = [(d, len((t or "").encode()), len(sp.encode(t or ""))) for d, t in rows]
    assert got == sorted([(*w, w[2] > 4096) for w in want], key=str)
    assert token_counts(frame([]), PIECES).collect() == []


def test_encoder_equals_library():
    encode = packing.encoder(WORDS)
    sample = texts(6000, 4)
    want = encode.tokenizer.encode_batch(sample, add_special_tokens=False)
    for text, w, got in zip(sample, want, encode.encode(sample)):
        assert np.array(w.ids, "<u4").tobytes() == got, repr(text)


def test_closing_marks_are_encoded_once(monkeypatch):
    """Words before marks go by their letters; only the marks go through the whole library."""
    encode, rnd = packing.Encoder(WORDS), random.Random(5)
    words = ["".join(rnd.choice("aeinorstéß") for _ in range(9)) for _ in range(500)]
    text = " ".join(w.title() + rnd.choice(["###", "!!", ".,", "***"]) for w in words)
    sent, library = [], encode._library
    monkeypatch.setattr(encode, "_library", lambda chunks: sent.extend(chunks) or library(chunks))
    got = encode.encode([text, "— " + text, "it's. 'a!' b' "])
    assert got == [np.array(encode.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in [text, "— " + text, "it's. 'a!' b' "]]
    assert len(sent) < 20


def test_encoder_forgets(monkeypatch):
    monkeypatch.setattr(packing, "MAX_CHUNKS", 40)
    monkeypatch.setattr(packing, "STEP_WORDS", 7)
    encode, sample = packing.Encoder(WORDS), texts(300, 6)
    for i in range(0, 300, 10):
        want = encode.tokenizer.encode_batch(sample[i:i + 10], add_special_tokens=False)
        assert encode.encode(sample[i:i + 10]) == [np.array(w.ids, "<u4").tobytes() for w in want]
        assert len(encode.known) == len(encode.first) == len(encode.sizes) and len(encode.table) == encode.sizes.sum()


def test_a_group_is_packed_as_arrow():
    """Ids of a group are never spelt out as objects."""
    import pyarrow as pa
    ids = [np.arange(n, dtype="<u4").tobytes() for n in (3, 8, 2, 8, 1)]
    rows = {"pack": [2] * 5, "doc_id": [9, 7, 7, 5, 5], "no_id": [0] * 5, "start": [0, 0, 8, 0, 8], "length": [3, 8, 2, 8, 1],
            "doc_tokens": [3, 10, 10, 9, 9], "ids": ids}
    whole = pa.table(rows, schema=packing._PIECES)
    got = packing._pack(8, packing.QUADRATIC)(pa.concat_tables([whole.slice(0, 2), whole.slice(2)])).to_pylist()
    assert [(r["doc_id"], r["start"], r["length"], r["sequence_id"] - (2 << 32), r["offset"]) for r in got] == [
        (5, 0, 8, 0, 0), (7, 0, 8, 1, 0), (9, 0, 3, 2, 0), (7, 8, 2, 2, 3), (5, 8, 1, 2, 5)]
    assert [r["ids"] for r in got] == [ids[3], ids[1], ids[0], ids[2], ids[4]]


def test_pieces_are_cut_alike_in_any_step(frame, monkeypatch):
    import pyarrow as pa
    batch = pa.record_batch([pa.array([0, 1, 0]), pa.array([7, 8, 9]), pa.array(["a few words " * 90, "", "one more"]), pa.array([0, 0, 0])],
                            ["pack", "doc_id", "text", "no_id"])
    want = pa.Table.from_batches(packing._pieces(WORDS, 64, 1)(iter([batch]))).to_pylist()
    monkeypatch.setattr(packing, "STEP_CHARS", 5)
    monkeypatch.setattr(packing, "STEP_IDS", 100)
    assert pa.Table.from_batches(packing._pieces(WORDS, 64, 1)(iter([batch]))).to_pylist() == want
    assert [(r["doc_id"], r["start"], r["length"]) for r in want] == [(7, 0, 64), (7, 64, 64), (7, 128, 64), (7, 192, 64), (7, 256, 15), (8, 0, 1), (9, 0, 3)]
    assert all(len(r["ids"]) == 4 * r["length"] for r in want)


@pytest.mark.parametrize("seed", range(4))
def test_assign_places_every_token_once(seed):
    rnd = random.Random(seed)
    lengths = [rnd.randint(1, 64) for _ in range(rnd.randint(1, 300))]
    placed = packing.assign(lengths, 64)
    used, covered = {}, {}
    for i, at, n, s, offset in placed:
        assert used.get(s, 0) == offset and offset + n <= 64
        used[s] = offset + n
        covered.setdefault(i, []).append((at, n))
    assert len(used) == -(-sum(lengths) // 64)
    for i, length in enumerate(lengths):
        at = 0
        for a, n in sorted(covered[i]):
            assert a == at and n > 0
            at += n
        assert at == length


def test_assign_balances_cost():
    cost = {}
    for _, _, n, s, _ in packing.assign([50, 50, 10, 10, 10, 10, 10, 10, 10, 10, 10, 10], 100, 0.1):
        cost[s] = cost.get(s, 0) + n + 0.1 * n * n
    assert max(cost.values()) - min(cost.values()) < 1e-9


def test_packed_laws(frame):
    encode = packing.encoder(WORDS)
    rows = [(1, None), (2, ""), (None, "x y"), (3, "same text"), (3, "same text"), (4, "Hello, world. " * 3000)]
    rows += [(10 + i, "tok " * (37 * i % 900)) for i in range(60)]
    got = packing.packed(frame(rows), WORDS, size=256, group_bytes=20_000).collect()
    by, seqs = {}, {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
        seqs.setdefault(r.sequence_id, []).append(r)
    for d, t in rows:
        if d == 3:
            continue
        ids, at = encode.encode([t or ""])[0] + np.array([1], "<u4").tobytes(), 0
        for r in sorted(by[d], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) // 4
            assert r.ids_crc32 == zlib.crc32(ids[4 * at:4 * (at + r.length)])
            at += r.length
        assert at == len(ids) // 4
    assert sum(r.length for r in by[3]) == 2 * by[3][0].doc_tokens
    for s in seqs.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 256
    assert packing.packed(frame([]), WORDS).collect() == []


def test_packed_hands_out_ids(frame):
    encode, stop = packing.encoder(WORDS), np.array([1], "<u4").tobytes()
    rows = [(1, "Hello, world. " * 300), (2, None), (3, "some words " * 40)]
    by = {}
    for r in packing.packed(frame(rows), WORDS, size=64).collect():
        assert len(r.ids) == 4 * r.length and r.ids_crc32 == zlib.crc32(r.ids)
        by.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
    assert {d: b"".join(x for _, x in sorted(parts)) for d, parts in by.items()} == {d: encode.encode([t or ""])[0] + stop for d, t in rows}
