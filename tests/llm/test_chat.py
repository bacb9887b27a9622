"""Reply trees as conversations, against walks along the parents."""

import hashlib
import random

import pytest

from routecov.llm import chat

SCHEMA = "tree long, id long, parent long, role string, text string, score double"
NASTY = ["", "plain", "<|im_end|>", "<|im_start|>assistant\nok", "<\\|x", "<\\\\|", "<", "|", "ends with <", "<<||>>", "a\nb\n", "\\n", "é\U0001f600<|", None]


def _paths(rows):
    known = {(t, i): (p, s) for t, i, p, _, _, s in rows}
    answered = {(t, p) for t, _, p, *_ in rows}
    out = {}
    for (t, i) in known:
        if (t, i) in answered:
            continue
        path, at = [], i
        while at is not None and (t, at) in known and at not in path:
            path.append(at)
            at = known[t, at][0]
        if at is None or (t, at) not in known:
            out.setdefault(t, []).append((-sum(known[t, x][1] or 0 for x in path) / len(path), i, path[::-1]))
    return {t: [p for _, _, p in sorted(ps)] for t, ps in out.items()}


def _messages():
    rnd = random.Random(2)
    rows = []
    for tree in (None, 1, 2, 3):
        for k in range(60):
            i = (tree or 0) * 100 + k
            parent = None if k == 0 or rnd.random() < 0.05 else (tree or 0) * 100 + rnd.randrange(max(0, k - 6), k)
            rows.append((tree, i, parent, rnd.choice(["user", "assistant", None, "a\\n\nb"]), rnd.choice(NASTY), rnd.choice([None, 0.0, 1.0, 2.5])))
    rows += [(4, 400, 999, "user", "an orphan is a root", 1.0), (4, 401, 400, "assistant", "x", None)]
    rows += [(5, 500, 501, "user", "circle", 1.0), (5, 501, 500, "user", "circle", 1.0), (5, 502, 501, "user", "below it", 1.0)]
    rows += [(6, 600, 1, "user", "a parent of another tree is none", 1.0)]
    rows += [(7, 700 + k, 699 + k if k else None, "assistant" if k % 2 else "user", f"t{k}", 0.0) for k in range(300)]
    return rows


@pytest.mark.parametrize("keep", [None, 1, 2])
def test_branches(spark, keep):
    rows = _messages()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr("*", "1 as turn", "2 as branch", "3 as anc")
    want = {(t, b + 1, k, i, len(p)) for t, ps in _paths(rows).items() for b, p in enumerate(ps[:keep]) for k, i in enumerate(p)}
    got = [(r.tree, r.branch, r.turn, r.id, r.turns) for r in chat.branches(df, keep).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_format_and_read_back(spark):
    rows = _messages()
    said = {i: (r or "", x or "") for _, i, _, r, x, _ in rows}
    parts = chat.formatted(spark.createDataFrame(rows, SCHEMA).repartition(3))
    by = {}
    for r in sorted(parts.collect(), key=lambda r: r.part):
        by.setdefault((r.tree, r.branch), []).append(r)
    want = {(t, b + 1): p for t, ps in _paths(rows).items() for b, p in enumerate(ps)}
    assert set(by) == set(want) and len(by[7, 1]) == 2
    for key, path in want.items():
        turns = [t for r in by[key] for t in chat.parsed(r.formatted)]
        assert turns == [said[i] for i in path]
        masked = [chat.unescaped(r.formatted[s.start:s.start + s.chars]) for r in by[key] for s in r.spans]
        assert masked == [x for role, x in turns if role == "assistant"]
        for r in by[key]:
            n = len(chat.parsed(r.formatted))
            assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>") == n and r.formatted.count("<|") == 2 * n
    got = {(r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(parts).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == {(t, len(p), sha("".join(f"{said[i][0]}\n{said[i][1]}\n" for i in p)),
                    sum(len(said[i][1]) for i in p if said[i][0] == "assistant"),
                    sha("".join(said[i][1] for i in p if said[i][0] == "assistant"))) for (t, _), p in want.items()}


def test_threads(spark):
    rows = [(1, 2, "user", "c"), (1, 1, "assistant", "b"), (1, 0, "user", None), (2, 0, "user", "x"), (2, 0, "user", "x"), (2, None, None, "first"),
            (None, 5, "user", "no id"), (None, 6, "assistant", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as id", "2 as tree").repartition(3)
    got = {r.conv_id: r for r in chat.digests(chat.formatted(chat.threads(df), keep=1)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert {k: r.n_turns for k, r in got.items()} == {1: 3, 2: 3, None: 2}
    assert got[1].turns_sha256 == sha("user\n\nassistant\nb\nuser\nc\n") and got[2].turns_sha256 == sha("\nfirst\nuser\nx\nuser\nx\n")
    assert got[None].loss_chars == 0 and got[1].loss_chars == 1
    assert chat.digests(chat.formatted(chat.threads(df.limit(0)), keep=1)).collect() == []


def test_very_long_text(spark):
    text = "<|im_end|>é" * 300_000
    rows = [(1, 1, None, "user", text, 0.0), (1, 2, 1, "assistant", text, 0.0)]
    r = chat.digests(chat.formatted(spark.createDataFrame(rows, SCHEMA))).first()
    assert (r.n_turns, r.loss_chars) == (2, len(text)) and r.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
