"""Merkle manifest of a dataset with inclusion proofs by pointer jumping.

Rows are hashed to leaves; the leaves of a group (source), in the order of
their ids, are the bottom of a tree whose nodes are hashes of at most ``fan``
consecutive nodes below; the groups' roots, in the order of the groups, are the
bottom of one more tree.  Every node then holds a segment, its siblings towards
its parent, and a pointer to the parent.  A self-join looks up the node that is
pointed at, appends its segment and takes over its pointer, so the distance
doubles with each join until all pointers are at the root and each leaf holds
its whole proof.

A row's place in its group is counted within the partitions of a range sort, so
a group that holds most rows lies in many tasks.  At distance d a node is the
target of at most fan ** d pointers and only nodes of level d or more are
targets: either they are few enough to broadcast or no key is hot.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, read_table
from .ordering import positions

#: Nodes that are hashed upwards together, as one group of a shuffle.
GROUP_NODES = 729
#: Targets of a self-join are broadcast up to this number of rows times hashes in their segments (32 bytes each).
BROADCAST_HASHES = 65_536
#: Rows of the table of places (four numbers and a group) that a join may broadcast, and the bytes of its groups.
BROADCAST_PLACES, BROADCAST_PLACE_BYTES = 200_000, 16 << 20


def digest(text: Column) -> Column:
    """SHA-256 of a text as 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def hexed(raw: Column) -> Column:
    return F.lower(F.hex(raw))


def field(value: Column) -> Column:
    """One field of a leaf: ``-`` for null, else the bytes of its text, ``:`` and the text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: Sequence[Column]) -> Column:
    return digest(F.concat(*[field(c) for c in fields]))


@dataclass
class Manifest:
    """Leaves with their proofs, and the root as hexadecimal text (None of an empty table).

    ``leaves`` has the columns given, ``leaf`` (binary) and ``proof``: one step
    a level from the leaf up, (l, r, top): the siblings to the left and to the
    right as bytes, and whether the level joins groups."""
    leaves: DataFrame
    root: str | None


def fold(proof: Column, leaf: Column) -> Column:
    """The hash (hexadecimal) that a leaf (bytes) and the steps of a proof lead to."""
    return F.aggregate(proof, hexed(leaf), lambda acc, x: F.sha2(F.concat(hexed(x["l"]), acc, hexed(x["r"])), 256))


def group_root(proof: Column, leaf: Column) -> Column:
    return fold(F.filter(proof, lambda x: ~x["top"]), leaf)


def siblings(proof: Column) -> Column:
    """All hashes of a proof as one text, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda x: hexed(F.concat(x["l"], x["r"]))), "")


def _height(n: int, fan: int) -> int:
    h = 0
    while n > 1:
        n, h = -(-n // fan), h + 1
    return h


def _placed(rows: DataFrame, group: str, order: Sequence[str]) -> tuple[DataFrame, int, int, int]:
    """own (all columns of ``rows``), leaf, s (number of the group), i (place in it), n (its size); the numbers of rows and groups and the largest size."""
    # all columns in one, so that no name meets the inner ones
    named = {"group": F.col(group), **{f"order{k}": F.col(c) for k, c in enumerate(order)}, "leaf": F.col("leaf"), "_row": F.monotonically_increasing_id()}
    rows, keys, group = cut_lineage(rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("own"), *[c.alias(k) for k, c in named.items()])), [*named], "group"
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ordered = cut_lineage(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_row")
                          .withColumns({"_part": F.spark_partition_id(), "_at": at}))
    spans = cut_lineage(ordered.groupBy("_part", group).agg(F.min("_at").alias("_first"), F.count("*").alias("_n")))
    numbered, groups, _ = positions(spans.select(group).distinct().withColumn("one", F.lit(1).cast("long")), [group], "one")
    numbered = numbered.select(F.col(group).alias("_g"), F.col("position").alias("s"))
    # a group has one row for each partition it lies in
    own = Window.partitionBy(group)
    before = F.coalesce(F.sum("_n").over(own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    places = spans.withColumns({"_before": before, "n": F.sum("_n").over(own)}).join(numbered, F.col(group).eqNullSafe(F.col("_g")))
    places = cut_lineage(places.select(F.col("_part").alias("_p"), "_g", "_first", "_before", "_n", "n", "s"))
    size = places.agg(F.count("*").alias("rows"), F.sum("_n").alias("all"), F.max("n").alias("n"), F.sum(F.octet_length("_g").cast("long")).alias("bytes")).first()
    if size["rows"] <= BROADCAST_PLACES and (size["bytes"] or 0) <= BROADCAST_PLACE_BYTES:
        places = F.broadcast(places)
    joined = ordered.join(places, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
    i = F.col("_at") - F.col("_first") + F.col("_before")
    return cut_lineage(joined.select("own", "leaf", "s", i.alias("i"), "n")), size["all"] or 0, groups, size["n"] or 0


def _climb(nodes: DataFrame, tree: Column, level: int, fan: int, top: bool) -> tuple[DataFrame, DataFrame]:
    """Nodes (s, i, n, hash, h) of one level, of trees with several: the nodes some levels above, and the links of all levels between.

    Runs of at most ``GROUP_NODES`` nodes are hashed up together, each to one
    node, or to the root of a tree that ends earlier."""
    steps = max(1, int(math.log(GROUP_NODES, fan) + 1e-9))
    span = fan ** steps
    runs = nodes.groupBy("s", "n", F.expr(f"i div {span}").alias("run")).agg(F.sort_array(F.collect_list(F.struct("i", "hash", "h"))).alias("m"))
    last = "element_at(acc, -1)"
    above = (f"transform(sequence(0, (size({last}) - 1) div {fan}), "
             f"k -> unhex(sha2(array_join(transform(slice({last}, cast(k * {fan} + 1 as int), {fan}), x -> lower(hex(x))), ''), 256)))")
    climbs = " + ".join(f"if((n + {fan ** j - 1}) div {fan ** j} > 1, 1, 0)" for j in range(steps))
    runs = cut_lineage(runs.select("s", "n", "run", F.expr(climbs).alias("climbs"), F.transform("m", lambda x: x["h"]).alias("heights"), F.expr(
        f"aggregate(sequence(1, {steps}), array(transform(m, x -> x.hash)), (acc, j) -> array_append(acc, {above}))").alias("levels")))
    each = runs.select("s", "run", "heights", F.posexplode(F.expr("slice(levels, 1, climbs)")).alias("j", "m")).select(
        "s", "j", "m", "heights", F.expr(f"run * cast(power({fan}, {steps} - j) as long)").alias("base"), F.expr("inline(transform(m, (x, p) -> struct(p)))").alias("p"))
    begin = F.expr(f"p - p % {fan} + 1")
    sides = each.withColumns({"ki": F.col("base") + F.col("p"), "left": F.slice("m", begin, F.expr(f"p % {fan}")),
                              "right": F.slice("m", F.col("p") + 2, F.expr(f"{fan - 1} - p % {fan}"))})
    together = "reduce({0}, X'', (a, x) -> concat(a, x))"
    bottom = F.col("j") == 0 if top and level == 0 else F.lit(False)  # a group's own root: group ki, level heights[p]
    links = sides.select(
        F.when(bottom, F.col("ki")).otherwise(tree).alias("ks"), F.when(bottom, F.expr("heights[p]")).otherwise(F.col("j") + level).alias("kl"),
        F.when(bottom, F.lit(0)).otherwise(F.col("ki")).alias("ki"),
        tree.alias("ts"), (F.col("j") + level + 1).alias("tl"), F.expr(f"ki div {fan}").alias("ti"),
        F.array(F.struct(F.expr(together.format("left")).alias("l"), F.expr(together.format("right")).alias("r"), F.lit(top).alias("top"))).alias("seg"))
    over = "cast(power({0}, climbs) as long)".format(fan)
    return runs.select("s", F.col("run").alias("i"), F.expr(f"(n + {over} - 1) div {over}").alias("n"), F.expr("levels[climbs][0]").alias("hash"),
                       (F.col("climbs") + level).alias("h")), links


def _climbed(nodes: DataFrame, size: int, tree: Column, fan: int, top: bool) -> tuple[DataFrame, list[DataFrame]]:
    """The roots (s, i, n, hash, h) of trees of at most ``size`` leaves, and all links."""
    ended, links, level = [], [], 0
    while size > 1:
        ended.append(nodes.where("n = 1"))
        nodes, up = _climb(nodes.where("n > 1"), tree, level, fan, top)
        links.append(up)
        steps = max(1, int(math.log(GROUP_NODES, fan) + 1e-9))
        size, level = -(-size // fan ** steps), level + steps
    return reduce(DataFrame.union, [*ended, nodes]), links


def _proofs(leaves: DataFrame, rows: int, groups: int, largest: int, fan: int) -> tuple[DataFrame, str]:
    """(ks, ki, seg): the whole proof of each leaf that has any, and the root."""
    upper = F.lit(-1).cast("long")
    height, top_height = _height(largest, fan), _height(groups, fan)
    roots, links = _climbed(leaves.select("s", "i", "n", F.col("leaf").alias("hash"), F.lit(0).alias("h")), largest, F.col("s"), fan, False)
    roots = roots.select(upper.alias("s"), F.col("s").alias("i"), F.lit(groups).cast("long").alias("n"), "hash", "h")
    summit, more = _climbed(roots, groups, upper, fan, True)
    root, links = summit.select(hexed(F.col("hash"))).first()[0], links + more
    spark = leaves.sparkSession
    if not links:
        return spark.createDataFrame([], "ks long, ki long, seg array<struct<l:binary,r:binary,top:boolean>>"), root
    # pointers at the root (of the upper tree, or of the only group) turn to places that nothing has, a place each
    at_root = (F.col("ts") == (-1 if top_height else 0)) & (F.col("tl") == (top_height or height))
    done = {"ti": F.when(at_root, F.xxhash64("ks", "kl", "ki")).otherwise(F.col("ti")), "ts": F.when(at_root, F.lit(-2)).otherwise(F.col("ts"))}
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = cut_lineage(reduce(DataFrame.union, links).withColumns(done).coalesce(tasks))
    far = 1
    while far < height + top_height:
        goals = held.where((F.col("ks") == -1) | (F.col("kl") >= far)).select(
            F.col("ks").alias("gs"), F.col("kl").alias("gl"), F.col("ki").alias("gi"),
            F.col("ts").alias("us"), F.col("tl").alias("ul"), F.col("ti").alias("ui"), F.col("seg").alias("more"))
        # at most so many nodes: of level `far` or more in each group, and all of the upper tree
        most = 1.5 * rows / fan ** far + groups * (height + 2) + top_height
        if most * (fan - 1) * far <= BROADCAST_HASHES:
            goals = F.broadcast(goals)
        found = F.col("gs").isNotNull()
        joined = held.join(goals, (F.col("ts") == F.col("gs")) & (F.col("tl") == F.col("gl")) & (F.col("ti") == F.col("gi")), "left").select(
            "ks", "kl", "ki", *[F.when(found, F.col(u)).otherwise(F.col(t)).alias(t) for t, u in (("ts", "us"), ("tl", "ul"), ("ti", "ui"))],
            F.when(found, F.concat("seg", "more")).otherwise(F.col("seg")).alias("seg"))
        far *= 2
        # what is neither a leaf nor a target of the next join has done its part
        held = cut_lineage(joined.where((F.col("ks") == -1) | (F.col("kl") == 0) | (F.col("kl") >= far)))
    return held.where((F.col("ks") >= 0) & (F.col("kl") == 0)).select("ks", "ki", "seg"), root


def manifest(leaves: DataFrame, group: str, order: Sequence[str], fan: int = 3) -> Manifest:
    """Proofs of rows with ``leaf`` (32 bytes), in one tree for each ``group``, its leaves by ``order``.

    Nulls come first in groups and order and count as values; rows that agree
    in both follow each other by leaf, equal ones in any order, each with a
    place of its own; a group of one leaf has that leaf as its root, an only
    group's root is the root.  Texts sort by their UTF-8 bytes.  No rows give
    no leaves and no root.  Other columns are carried along whatever their
    names; one named ``proof`` is replaced."""
    if fan < 2:
        raise ValueError("fan must be at least 2")
    rows, number, groups, largest = _placed(leaves.drop("proof"), group, order)
    none = F.expr("cast(array() as array<struct<l:binary,r:binary,top:boolean>>)")
    if not groups:
        return Manifest(rows.select("own.*", none.alias("proof")), None)
    proofs, root = _proofs(rows, number, groups, largest, fan)
    joined = rows.join(proofs, (F.col("s") == F.col("ks")) & (F.col("i") == F.col("ki")), "left")
    return Manifest(joined.select("own.*", F.coalesce("seg", none).alias("proof")), root)


def document_leaves(docs: DataFrame) -> DataFrame:
    """doc_id, source, leaf and tampered: the leaf of the text without line
    feeds where crc32 of the decimal id is even, else null (also for a null id or text)."""
    def leaf(text: Column) -> Column:
        return leaf_hash([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text])

    chosen = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return docs.select("doc_id", "source", leaf(F.col("text")).alias("leaf"),
                       F.when(chosen & F.contains("text", F.lit("\n")), leaf(F.replace("text", F.lit("\n"), F.lit("")))).alias("tampered"))


def op13_merkle(spark, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root, proof and the check of a tampered copy for every row of ``documents``."""
    made = manifest(document_leaves(read_table(spark, sf_dir, "documents")), "source", ["doc_id"])
    root, proof = F.lit(made.root).cast("string"), F.col("proof")
    return made.leaves.select(
        "doc_id", hexed(F.col("leaf")).alias("leaf"), group_root(proof, F.col("leaf")).alias("subroot"), root.alias("root"),
        F.sha2(siblings(proof), 256).alias("proof_sha256"), fold(proof, F.coalesce("tampered", "leaf")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
