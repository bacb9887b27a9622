"""Near-duplicate components against brute force."""

import random
import re
import uuid

from corpus_frames import frame  # noqa: F401 - a fixture
from routecov.llm import near_dedup as nd
from routecov.llm.components import star_components


def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if rows[i][0] is not None and rows[j][0] is not None and c and 100 * c >= 75 * (len(sets[i]) + len(sets[j]) - c):
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        group = [rows[j][0] for j in range(len(rows)) if find(j) == find(i)]
        low = min(group) if d is not None else None
        out.append((d, len(sets[i]), low, d is None or d == low))
    return sorted(out, key=str)


def copies(seed, base_words=60, n=40):
    rnd = random.Random(seed)
    base = [f"w{rnd.randint(0, 500)}" for _ in range(base_words)]
    rows = []
    for i in range(n):
        w = list(base)
        for _ in range(rnd.randint(0, 5)):
            w[rnd.randrange(len(w))] = f"x{rnd.randint(0, 9)}"
        rows.append((100 * seed + i, " ".join(w)))
    return rows


def test_components_equal_brute_force(frame, monkeypatch):
    rows = copies(1) + copies(2, 200, 12) + copies(3, 30, 25)
    rows += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "one two"), (1004, "ONE\ttwo"), (1005, "one two three four five"),
             (None, rows[0][1]), (1006, "ä Ä"), (1007, "Ä Ä"), (1008, rows[0][1]), (1008, rows[0][1]),
             (1009, "long " + " ".join(f"v{i % 977}" for i in range(60_000))), (1010, "long " + " ".join(f"v{i % 977}" for i in range(60_001)))]
    got = nd.near_duplicates(frame(rows)).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows)


def test_blocks_and_empty(frame, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 8)
    rows = copies(5, 40, 40)
    assert sorted([tuple(r) for r in nd.near_duplicates(frame(rows)).collect()], key=str) == brute(rows)
    assert nd.near_duplicates(frame([])).collect() == []


def test_star_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (102, 101), (7, 7), (101, 100), (None, 3)]
    got = {tuple(r) for r in star_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {(i, 1) for i in range(1, 41)} | {(100, 100), (101, 100), (102, 100)}
    assert star_components(spark.createDataFrame([], "a long, b long")).collect() == []


def tasks_of(spark, work):
    """Result of ``work`` and the number of tasks that it ran, on many shuffle partitions that are not put together."""
    held = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = work()
        status = spark.sparkContext.statusTracker()
        stages = {s for j in status.getJobIdsForGroup(group) for s in status.getJobInfo(j).stageIds}
        return out, sum(i.numCompletedTasks for s in stages if (i := status.getStageInfo(s)))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_small_graph_costs_few_tasks(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(600), rng.randrange(600)) for _ in range(400)] + [(1000, 1000 + i) for i in range(1, 500)]
    rows = spark.createDataFrame(edges, "a long, b long")
    got, tasks = tasks_of(spark, lambda: {tuple(r) for r in star_components(rows).collect()})
    root = {}
    for a, b in sorted((min(e), max(e)) for e in edges if e[0] != e[1]):
        root.setdefault(a, a), root.setdefault(b, b)
        low, high = sorted((root[a], root[b]))
        root = {k: low if v == high else v for k, v in root.items()}
    assert got == set(root.items())
    assert tasks < 2000  # 5,258 when each step of a round had a task for each shuffle partition, or several
