"""Merkle proofs against a plain tree."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from routecov.llm import merkle

DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def _h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(row, text):
    return _h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)))


def _levels(nodes, fan):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([_h("".join(out[-1][k:k + fan])) for k in range(0, len(out[-1]), fan)])
    return out


def _steps(levels, i, fan):
    out = []
    for level in levels[:-1]:
        first = i // fan * fan
        out.append(("".join(level[first:i]), "".join(level[i + 1:first + fan])))
        i //= fan
    return out


def _brute(rows, fan=3):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r, r[4])))
        trees[s] = _levels([_leaf(r, r[4]) for r in by[s]], fan)
    top = _levels([trees[s][-1][0] for s in sources], fan)
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(by[s]):
            steps = _steps(trees[s], i, fan) + _steps(top, k, fan)
            changed = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            at = _leaf(r, r[4].replace("\n", "") if changed else r[4])
            for left, right in steps:
                at = _h(left + at + right)
            out.append((r[0], trees[s][0][i], trees[s][-1][0], top[-1][0], _h("".join(a + b for a, b in steps)), at, at == top[-1][0]))
    return sorted(out, key=str)


def _rows(n, sources, seed):
    rnd = random.Random(seed)
    return [(rnd.choice([None, i, i // 2]), rnd.choice(sources), rnd.choice(["en", None, "é"]), rnd.choice([None, i]), rnd.choice([None, "", "a\nb", "x", "\n", "ü\n" * 9]))
            for i in range(n)]


CASES = {
    "hot source": [(i, "hot", None, 1, f"t\n{i}") for i in range(130)] + _rows(40, [None, "", "b", "é", "z", "Z"], 1),
    "one source": _rows(28, ["s"], 2),
    "one leaf": [(4, None, None, None, None)],
    "only small": [(i, f"s{i}", "en", 1, "a\n") for i in range(11)],
    "repeated": [(7, "s", "en", 3, "a\nb")] * 9 + [(7, "s", "en", 3, None)] * 2,
    "long": [(1, "s", "en", 3, "line\n" * 500_000), (2, "t", "en", 3, "line")],
    "empty": [],
}


@pytest.mark.parametrize("case", CASES)
def test_documents(spark, tmp_path, case):
    rows = CASES[case]
    df = spark.createDataFrame(rows, DOCS).repartition(3).selectExpr("*", "1 as s", "2 as i", "3 as leaf", "'p' as proof", "4 as `a.b`")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = merkle.op13_merkle(spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == _brute(rows)


def test_other_fan_and_columns(spark):
    rows = _rows(50, ["a", "b", None], 3)
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    leaves = merkle.document_leaves(df).selectExpr("*", "1 as s", "2 as n", "'old' as proof", "doc_id as `x.y`")
    made = merkle.manifest(leaves, "source", ["doc_id"], fan=5)
    got = made.leaves.select("doc_id", merkle.hexed(F.col("leaf")).alias("leaf"), merkle.group_root(F.col("proof"), F.col("leaf")).alias("sub"),
                             F.sha2(merkle.siblings(F.col("proof")), 256).alias("p"), "s", "n", "`x.y`").collect()
    want = _brute(rows, 5)
    assert sorted([(r.doc_id, r.leaf, r["sub"], r.p) for r in got], key=str) == sorted([(w[0], w[1], w[2], w[4]) for w in want], key=str)
    assert made.root == want[0][3] and {(r.s, r.n) for r in got} == {(1, 2)}


def test_self_joins_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST_HASHES", 0)
    monkeypatch.setattr(merkle, "BROADCAST_PLACES", 0)
    rows = CASES["hot source"]
    leaves = merkle.document_leaves(spark.createDataFrame(rows, DOCS).repartition(3))
    made = merkle.manifest(leaves, "source", ["doc_id"])
    got = made.leaves.select("doc_id", F.sha2(merkle.siblings(F.col("proof")), 256).alias("p")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(w[0], w[4]) for w in _brute(rows)], key=str)
