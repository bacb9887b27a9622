"""Conversations from reply trees.

Messages point at the message they answer.  Every message looks up the one it
points at in a self-join, adds the score gathered there to its own and takes
over its pointer, so that after k joins it has seen 2 ** k messages towards
the root.  That ranks the branches of a tree, each named by its leaf, before
any of them is spelled out.  The chosen branches are then enumerated with the
pointers of the rounds in reverse: each place found so far also yields the one
2 ** k higher.  Only ids and scores take part in these joins; texts meet their
places at the end.

A turn is ``<|im_start|>role, line feed, text, <|im_end|>, line feed``.  Inside
texts and roles each ``<|`` gets a backslash in the middle, or one more where
backslashes already stand there, so no control string is left and the change
can be undone.  A conversation comes in parts of a bounded number of turns,
each with the spans of its text that a loss is taken on; their concatenation
is the conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from routecov.session import scratch_path

from .common import cut_lineage, read_table
from .ordering import positions

# The marks of a turn.
START, END = "<|im_start|>", "<|im_end|>"
#: The role whose texts the loss is taken on.
LOSS_ROLE = "assistant"
#: Turns in one part of a formatted conversation.
PART_TURNS = 256

DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def escaped_role(role: Column) -> Column:
    """A role on one line: backslashes doubled, line feeds as ``\\n``."""
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def unescaped_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(role))


def _climbed(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(tree, id, total, hops) of every message that has a root, and per round k the pointers (id, anc) 2 ** k higher."""
    ids = messages.select(F.col("tree").alias("t"), F.col("id").alias("known"))
    links = messages.where("parent is not null").select("tree", "id", "parent").join(
        ids, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("known")), "leftsemi")
    state = cut_lineage(messages.select("tree", "id", F.coalesce("score", F.lit(0)).cast("double").alias("total"), F.lit(1).cast("long").alias("hops")).join(
        links.select(F.col("id").alias("child"), F.col("parent").alias("anc")), F.col("id") == F.col("child"), "left").drop("child"))
    ups, alive = [], None
    while True:
        up = state.where("anc is not null")
        left = up.count()
        if left in (0, alive):  # none, or only circles and what hangs on them: those have no root
            return state.where("anc is null").select("tree", "id", "total", "hops"), ups
        ups.append(up.select("id", "anc"))
        goal = state.select(F.col("id").alias("gid"), F.col("total").alias("gt"), F.col("hops").alias("gh"), F.col("anc").alias("ga"))
        moved = up.join(goal, F.col("anc") == F.col("gid")).select(
            "tree", "id", (F.col("total") + F.col("gt")).alias("total"), (F.col("hops") + F.col("gh")).alias("hops"), F.col("ga").alias("anc"))
        state, alive = cut_lineage(state.where("anc is null").select(*moved.columns).union(moved)), left


def branches(messages: DataFrame, keep: int | None = None) -> DataFrame:
    """(tree, branch, id, turn, turns): the messages (tree, id, parent, score) on the chosen root-to-leaf paths.

    ``branch`` is the rank of a path in its tree, from 1: highest mean score
    first (null counts as 0), then smallest leaf id; ``keep`` is the number of
    branches that stay (None: all).  ``id`` must be unique and not null; a
    parent that is null or not in the tree makes a root; messages on a circle of
    replies, or below one, have no root and belong to no path.  A null tree is
    a tree; no messages give no rows."""
    reached, ups = _climbed(messages)
    answered = messages.where("parent is not null").select(F.col("tree").alias("t"), F.col("parent").alias("p")).distinct()
    leaves = reached.join(answered, F.col("tree").eqNullSafe(F.col("t")) & (F.col("id") == F.col("p")), "leftanti")
    leaves = leaves.selectExpr("tree", "id as leaf", "hops as turns", "total / hops as mean")
    # with `keep`, each task passes on only the best of a tree
    ranked = leaves.selectExpr("*", "row_number() over (partition by tree order by mean desc, leaf) as branch")
    if keep is not None:
        ranked = ranked.where(F.col("branch") <= keep)
    places = cut_lineage(ranked.selectExpr("tree", "branch", "leaf as id", "turns", "0L as up"))
    for k in range(len(ups) - 1, -1, -1):
        higher = places.join(ups[k].select(F.col("id").alias("below"), "anc"), F.col("id") == F.col("below")).select(
            "tree", "branch", F.col("anc").alias("id"), "turns", (F.col("up") + (1 << k)).alias("up"))
        places = cut_lineage(places.union(higher))
    return places.selectExpr("tree", "branch", "id", "turns - 1 - up as turn", "turns")


def formatted(messages: DataFrame, keep: int | None = None, loss_role: str = LOSS_ROLE) -> DataFrame:
    """(tree, branch, turns, part, formatted, spans): the chosen branches of messages (tree, id, parent, role, text, score) as text.

    Parts number from 0 and hold ``PART_TURNS`` turns; ``spans`` lists (start,
    chars) of the part's text under the loss mask, one for each text of
    ``loss_role`` in order, counted in code points.  Null texts and roles are
    empty; further columns are ignored; see ``branches`` for the rest."""
    places = branches(messages, keep)
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = messages.select(F.col("id").alias("mid"), F.concat(F.lit(START), escaped_role(role), F.lit("\n")).alias("head"),
                           escaped(text).alias("body"), (role == loss_role).alias("loss"))
    turns = places.join(said, F.col("id") == F.col("mid"))
    parts = turns.groupBy("tree", "branch", "turns", F.expr(f"turn div {PART_TURNS}").alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("turn", "head", "body", "loss"))).alias("m"))
    end = F.lit(END + "\n")
    # where each turn begins: running sum of the lengths before it
    at = F.expr(f"slice(aggregate(m, array(0L), (a, x) -> array_append(a, a[size(a) - 1] + length(x.head) + length(x.body) + {len(END) + 1})), 1, size(m))")
    spans = F.expr("transform(filter(arrays_zip(m, at), x -> x.m.loss), "
                   "x -> named_struct('start', x.at + length(x.m.head), 'chars', cast(length(x.m.body) as long)))")
    return parts.withColumn("at", at).select(
        "tree", "branch", "turns", "part",
        F.array_join(F.transform("m", lambda x: F.concat(x["head"], x["body"], end)), "").alias("formatted"),
        spans.alias("spans"))


def parsed(text: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted text."""
    out = []
    for turn in text.split(START)[1:]:
        role, _, body = turn[:-len(END) - 1].partition("\n")
        out.append((unescaped_role(role), unescaped(body)))
    return out


def digests(parts: DataFrame) -> DataFrame:
    """One row a conversation read back from its parts: DIGEST.

    A task reads the sorted parts one by one and keeps only the hashes of the
    conversation it is in, so one conversation of any length takes one part's
    memory (and one task, as its hash runs from the first turn to the last)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in DIGEST.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        done: list[tuple] = []
        key = turns = loss = None
        n = loss_chars = chars = 0

        def end() -> None:
            if turns is not None:
                done.append((key[0], n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*done), types)] if done else [pa.array([], t) for t in types]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for i in range(batch.num_rows):
                mine = (batch["tree"][i].as_py(), batch["branch"][i].as_py())
                if turns is None or mine != key:
                    end()
                    key, turns, loss, n, loss_chars, chars = mine, hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                text = batch["formatted"][i].as_py()
                for role, body in parsed(text):
                    turns.update(f"{role}\n{body}\n".encode())
                    n += 1
                for span in batch["spans"][i].as_py():
                    body = unescaped(text[span["start"]:span["start"] + span["chars"]])
                    loss.update(body.encode())
                    loss_chars += len(body)
                chars += len(text)
            yield flush()
        end()
        yield flush()

    kept = parts.select("tree", "branch", "part", "formatted", "spans")
    return kept.repartition("tree", "branch").sortWithinPartitions("tree", "branch", "part").mapInArrow(run, DIGEST)


def threads(rows: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as messages: each row answers the one before it.

    Rows of a conversation follow by turn, then role and a hash of the text
    (nulls first); equal rows all stay.  The rows are written once, with a
    number each, and only numbers and keys are sorted; the row before another
    is found by its place in that order, however many rows one conversation has."""
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "chat-rows")
    rows.select(F.col("conv_id").cast("long").alias("tree"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
                F.col("text").cast("string").alias("text")).withColumns(
        {"hash": F.xxhash64("text"), "id": F.monotonically_increasing_id()}).write.parquet(path)
    stored = spark.read.parquet(path)
    order = ["tree", "turn", "role", "hash", "id"]
    placed, _, _ = positions(stored.select(*order).withColumn("one", F.lit(1).cast("long")), order, "one")
    placed = cut_lineage(placed.select("tree", "id", "position"))
    before = placed.select(F.col("tree").alias("t"), F.col("id").alias("parent"), (F.col("position") + 1).alias("next"))
    links = placed.join(before, (F.col("position") == F.col("next")) & F.col("tree").eqNullSafe(F.col("t"))).select(F.col("id").alias("child"), "parent")
    return stored.join(links, F.col("id") == F.col("child"), "left").select("tree", "id", "parent", "role", "text", F.lit(0.0).alias("score"))


def op11_chat(spark, sf_dir: str) -> DataFrame:
    """All ``conversations`` and conversation -1, formatted, written and read back."""
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = read_table(spark, sf_dir, "conversations").select(*extra.columns).union(extra)
    path = scratch_path(spark, "chat")
    formatted(threads(rows), keep=1).write.parquet(path)
    return digests(spark.read.parquet(path))
