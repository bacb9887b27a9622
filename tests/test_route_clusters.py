"""R5 and the prefix-filter join against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from routecov.operators import overlap, route_clusters as rc
from routecov.operators import sizing, skew


def _sets(n, universe, longest, seed, hub=None):
    rnd = random.Random(seed)
    out, base = set(), [rnd.randrange(universe) for _ in range(8)]
    while len(out) < n:
        s = set(rnd.sample(range(universe), rnd.randint(1, longest)))
        if rnd.random() < 0.5:  # near copies of one set
            s = set(base) - {rnd.choice(base)} | ({rnd.randrange(universe)} if rnd.random() < 0.5 else set())
        out.add(frozenset(s | ({hub} if hub is not None else set())))
    return list(out)


def _all_pairs(sets, percent):
    return sorted((i, j, len(sets[i] & sets[j])) for i in range(len(sets)) for j in range(i + 1, len(sets))
                  if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]))


@pytest.mark.parametrize("percent,hub,seed", [(51, None, 1), (60, 999, 2), (75, None, 3), (75, 999, 4), (100, 999, 5)])
def test_similar_sets_equal_all_pairs(spark, percent, hub, seed):
    sets = _sets(120, 25, 10, seed, hub)
    df = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], "id long, items array<long>").repartition(3)
    want = _all_pairs(sets, percent)
    assert rows(overlap.similar_sets(df, percent), "a", "b", "shared") == want and (percent > 75 or want)


def test_hub_in_every_route_makes_no_candidates(spark):
    """A zone that all routes share: no row of the join is made by it alone."""
    n = 2000
    sets = [(i, [10_000_000] + [100 * i + k for k in range(6)]) for i in range(n)] + [(n + i, [10_000_000] + [100 * i + k for k in range(5)]) for i in range(5)]
    df = spark.createDataFrame(sets, "id long, items array<long>")
    pairs = overlap.similar_sets(df, 75)
    assert rows(pairs, "a", "b", "shared") == [(i, n + i, 6) for i in range(5)]
    metrics = {}

    def walk(plan):
        name = plan.nodeName()
        if "Join" in name:
            metrics.setdefault(name, []).append(plan.metrics().apply("numOutputRows").value())
        for k in range(plan.children().size()):
            walk(plan.children().apply(k))
    plan = pairs._jdf.queryExecution().executedPlan()
    pairs._jdf.collect()
    walk(plan.executedPlan() if hasattr(plan, "executedPlan") else plan)
    assert not metrics or max(max(v) for v in metrics.values()) <= 100


def test_rarest_first_beyond_the_broadcast_bound(spark, monkeypatch):
    sets = _sets(60, 12, 6, 9, hub=77)
    df = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], "id long, items array<long>")
    want = rows(overlap.similar_sets(df, 75))
    monkeypatch.setattr(overlap, "BROADCAST_MAX_ROWS", 3)
    assert rows(overlap.similar_sets(df, 75)) == want


def _brute_clusters(paths, percent, m):
    items = {p: frozenset(z for z in p if z is not None) for p, _ in paths if p}
    known = [p for p in items if len(items[p]) >= m]
    parent = {p: p for p in known}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p
    for p in known:
        for q in known:
            a, b = items[p], items[q]
            if 100 * len(a & b) >= percent * len(a | b):
                parent[root(p)] = root(q)
    groups = {}
    for p in known:
        groups.setdefault(root(p), []).append(p)
    out = []
    for members in groups.values():
        total = sum(f for p, f in paths if p in set(members))
        out += [(p, min(members), len(members), total) for p in members]
    return sorted(out)


@pytest.mark.parametrize("m", [1, 4])
def test_route_clusters(spark, m):
    rnd = random.Random(11)
    paths = [(tuple(s), rnd.randint(1, 9)) for s in _sets(80, 20, 8, 6)]
    paths += [(tuple(reversed(paths[0][0])), 3), paths[1], ((1, 2, 1, 2, 3, 4), 5), ((4,), 1), ((), 7)]
    df = spark.createDataFrame([(list(p), f) for p, f in paths] + [(None, 2)], "trip_path array<long>, frequency long").repartition(3)
    got = [(tuple(r.trip_path), tuple(r.cluster), r.cluster_routes, r.cluster_frequency) for r in rc.route_clusters(df, 75, m).collect()]
    assert sorted(got) == _brute_clusters(paths, 75, m)
    assert rc.route_clusters(df.limit(0), 75, m).collect() == []


def test_percent_bounds(spark):
    df = spark.createDataFrame([(1, [1, 2])], "id long, items array<long>")
    for bad in (50, 101):
        with pytest.raises(ValueError):
            overlap.similar_sets(df, bad)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_join(spark, how):
    """One key holds half of the rows and is split; the result is that of a plain join."""
    left = spark.range(4000).select(F.col("id"), F.when(F.col("id") % 2 == 0, F.lit(7)).when(F.col("id") % 101 == 0, F.lit(None)).otherwise(F.col("id") % 50).cast("long").alias("k"))
    right = spark.range(60).where("id % 3 != 0").select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    heavy = skew.heavy_keys(left, ["k"], 8)
    known = left.where("k is not null")
    assert [(r.k, r._copies) for r in heavy.collect()] == [(7, -(-known.where("k = 7").count() * 8 * skew.PARTS // known.count()))]
    got = skew.skew_join(left, right, ["k"], how, tasks=8)
    want = left.join(right, ["k"], how)
    assert sorted(map(tuple, got.select(*sorted(got.columns)).collect()), key=str) == sorted(map(tuple, want.select(*sorted(want.columns)).collect()), key=str)
    with pytest.raises(ValueError):
        skew.skew_join(left, right, ["k"], "right")


def test_skew_join_spreads_a_hot_key(spark):
    """Half of the rows under one key: the largest task reads less than twice the median."""
    confs = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    for c, v in confs.items():
        spark.conf.set(c, v)
    try:
        left = spark.range(40000).select(F.col("id"), F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"))
        right = spark.range(40000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
        got = skew.skew_join(left, right, ["k"])
        per_task = sorted(r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect())
        plain = [r["count"] for r in left.join(right, "k").groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(per_task) == 40000 and max(plain) > 20000
        assert per_task[-1] < 2 * per_task[len(per_task) // 2]
    finally:
        for c in confs:
            spark.conf.unset(c)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_materialised_broadcast_reads_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(part):
        for x in part:
            seen.add(1)
            yield x
    df = spark.createDataFrame(spark.sparkContext.parallelize([(i % 3, i) for i in range(30)]).mapPartitions(count), "k int, v int")
    sizing.broadcast_materialised(df.groupBy("k").count()).collect()
    assert seen.value == 30
