"""Global positions, Hilbert shards, WARC files and top-k search against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpus_frames import frame  # noqa: F401 - a fixture
from routecov.llm import sharding, topk, warc
from routecov.llm.ordering import positions


def test_positions(spark):
    rnd = random.Random(1)
    rows = [(rnd.randint(0, 50), rnd.randint(0, 9), rnd.randint(1, 5)) for _ in range(500)]
    df, n, total = positions(spark.createDataFrame(rows, "a long, b long, w long").repartition(7), ["a", "b"], "w")
    got = sorted(df.collect(), key=lambda r: r.position)
    assert (n, total) == (500, sum(r[2] for r in rows)) and [r.position for r in got] == list(range(500))
    assert [(r.a, r.b) for r in got] == sorted((a, b) for a, b, _ in rows)
    before = 0
    for r in got:
        assert r.before == before
        before += r.w


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_index_is_a_curve(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij")).reshape(dims, -1)
    index = sharding.hilbert_index(cells, bits)
    assert sorted(index) == list(range(1 << (bits * dims)))
    walk = cells[:, np.argsort(index)]
    assert (np.abs(np.diff(walk, axis=1)).sum(0) == 1).all()


def test_sharded_laws(frame):
    rows = [(i, f"text {i % 7}" * (i % 11), ["de", "en", None][i % 3]) for i in range(101)] + [(5, None), (None, "x"), (6, "text 6"), (6, "text 6")]
    got = sharding.sharded(frame(rows)).collect()
    counts = [sum(r.shard == s for r in got) for s in range(16)]
    assert len(got) == len(rows) and max(counts) - min(counts) <= 1
    for s in range(16):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    assert all(r["size"] >= 1 and r.law == "rows" and r.grown_shard is None for r in got)
    assert sharding.sharded(frame([])).collect() == []
    assert [r.slot for r in sharding.sharded(frame([(1, "a")])).collect()] == [0]


def test_write_shards(spark, frame, tmp_path):
    rows = [(i, f"t{i}") for i in range(40)] + [(None, None), (3, "t3")]
    sharding.write_shards(frame(rows), str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted([(r.doc_id, r.text) for r in back.collect()], key=str) == sorted(rows, key=str)
    assert back.select("shard").distinct().count() == 4


def test_warc_round_trip(spark, tmp_path):
    big = "é<p>" * 4000
    rows = [(1, "http://a/ b\r\nX: y", "h" * 100), (2, "http://b", "h" * 100), (3, None, None), (4, "", ""), (5, "u", "short"), (6, "u", "short"),
            (7, "http://ü", big), (9, "http://c", big), (8, "http://d", big), (None, "n", "h" * 100), (10, "r", "k" * 200), (10, "r", "k" * 200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(0)).repartition(3)
    uri = "file://" + str(tmp_path / "w")
    files = warc.write_archive(pages, uri, shard_bytes=9000, roll_bytes=300).collect()
    assert sum(f.records for f in files) == len(rows) and len(files) > 2
    assert not list((tmp_path / "w").glob("_temporary*"))
    for f in files:
        data = (tmp_path / "w" / f.file).read_bytes()
        assert len(data) == f.bytes and hashlib.sha256(data).hexdigest() == f.sha256
    got = warc.read_archive(spark, uri).collect()
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        first = min(p for p, _, h in rows if h == html and p is not None) if len(data) >= 100 else page
        want.append((page, len(data), hashlib.sha256(data).hexdigest(), "response" if first == page else "revisit", None if first == page else first))
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == sorted(want, key=str)
    assert all(bytes(r.payload).decode() == {p: h or "" for p, _, h in rows}[r.page_id] for r in got if r.record_type == "response")
    again = "file://" + str(tmp_path / "again")
    assert sorted(map(tuple, warc.write_archive(pages.repartition(5), again, shard_bytes=9000, roll_bytes=300).collect())) == sorted(map(tuple, files))
    none = "file://" + str(tmp_path / "none")
    assert warc.write_archive(pages.limit(0), none).collect() == [] and warc.read_archive(spark, none).collect() == []


def test_top_k_equals_brute_force(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.gauss(0, 1 + i % 5) for _ in range(6)]) for i in range(300)]
    rows += [(400 + i, [0.5, 0.25, -1.0, 0.0, 2.0, 1.0]) for i in range(30)] + [(450, None), (500, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
             (550, [float("nan")] * 6), (600, [0.0] * 6), (650, [1.0, 2.0]), (651, [2.0, 2.0]), (None, [1.0] * 6), (50, rows[50][1]), (700, [1e9] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("vector", F.lit(1)).repartition(4)
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, bucket=64, block=8, seed=16).collect()
    clean = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q, a in clean.items():
        if q % 50 == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in clean.items() if i != q and len(a) == len(b))[:5]
            want += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []
