"""Removal of lines that repeat, exactly or within a few edits, across documents.

Equal lines are grouped first.  Distinct lines then meet by the pigeonhole of
a segment partition: cut into ``edits`` + 1 segments, a line within that many
edits of another leaves one segment whole.  Segments are indexed with the
line's length and their number; a line probes, for its own and each smaller
admissible length, only those of its substrings that can be the segment when
edits before and after it are counted against the limit.  Where many lines
share a segment, such as versions of one passage, each is compared with the
earliest of them; the rest of each must still be within the limit, so where
that leaves too many comparisons the rests are partitioned in turn.
Pairs are verified by a bit-parallel automaton over the diagonals of
the band.  All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routecov.session import scratch_path

from .common import cut_lineage, read_table, text_of

EDITS = 2
#: Shorter lines are only compared for equality.
LEAST_CHARS = 30
#: Where more lines than this share a segment, what is left of them is partitioned again, at most so often.
CROWD, LEVELS = 8, 8
#: Comparisons within crowds for each line of the input; beyond them the crowds are partitioned again.
COMPARISONS = 32
#: Bytes of an already materialised side that a join may broadcast.
BROADCAST_BYTES = 16 << 20
#: Bytes of it in one partition.
PARTITION_BYTES = 1 << 20


def _bounded(df: DataFrame) -> DataFrame:
    """``df``, materialised; if its measured bytes are few, in few partitions and with a broadcast hint."""
    df = cut_lineage(df)
    size = F.lit(16 * len(df.columns))  # 16 bytes a number, 48 more a struct, 8 an element of an array
    for f in df.schema.fields:
        if f.dataType.typeName() == "struct":
            size = size + 48
        elif f.dataType.typeName() == "array":
            size = size + 8 * F.size(f.name)
    held = df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df.coalesce(1 + held // PARTITION_BYTES)) if held <= BROADCAST_BYTES else df


def shifts(edits: int) -> list[tuple[int, int, int]]:
    """(length difference, segment, shift of its start) that a probe has to try."""
    out = []
    for shorter in range(edits + 1):
        for i in range(edits + 1):
            after = edits - i
            for shift in range(max(-i, shorter - after), min(i, shorter + after) + 1):
                out.append((shorter, i, shift))
    return out


def within(a: str, b: str, edits: int) -> str:
    """SQL for whether two arrays of characters are at most ``edits`` apart.

    One number holds, for each count of errors, a set of diagonals of the band
    as bits: those where the automaton has read as many characters of ``a`` as
    of ``b``, shifted by the diagonal.  Reading a character keeps the diagonals
    on which it matches; an error moves the set one count up, in place (other
    character), one diagonal down (character of ``b`` only) or up (of ``a``
    only).  The number is 0 once no diagonal is left."""
    width = 2 * edits + 1
    low = sum(1 << (e * width) for e in range(edits + 1))
    high, every = low << (width - 1), (1 << (width * (edits + 1))) - 1

    def skips(x: str) -> str:  # characters of a only, up to the number of edits
        for _ in range(edits):
            x = let(x, "k", f"k | (shiftleft(k & {every & ~high}L, {width + 1}) & {every}L)")
        return x

    same = " + ".join(f"if(get({a}, i + {d - edits}) <=> get({b}, i) and get({b}, i) is not null, {1 << d}L, 0L)" for d in range(width))
    step = let(f"({same}) * {low}L", "m", f"(s & m) | (shiftleft(s, {width}) & {every}L)"
               f" | shiftright(shiftleft(s, {width}) & {every & ~low}L, 1)")
    start = 0
    for e in range(edits + 1):
        for d in range(e + 1):
            start |= 1 << (e * width + edits + d)
    ended = f"(shiftright(s, cast({edits * width + edits} + size({a}) - size({b}) as int)) & 1L) = 1L"
    return (f"abs(size({a}) - size({b})) <= {edits} and aggregate(sequence(0, size({b})), {start}L, "
            f"(s, i) -> if(s = 0L or i >= size({b}), s, {skips(step)}), s -> {ended})")


def let(value: str, name: str, body: str) -> str:
    """SQL that evaluates ``value`` once and ``body`` with it as ``name``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def close(la: str, lb: str, edits: int) -> str:
    """SQL for whether two texts are at most ``edits`` apart.

    Their common beginning, then their common end, found by halving steps,
    change nothing and are left out; what remains of a close pair is short."""
    sizes = f"array({', '.join(str(1 << k) for k in range(20, -1, -1))})"

    def common(u: str, a: str, b: str) -> str:
        return f"aggregate({sizes}, 0, (p, z) -> p + if(p + z <= {u}.n and {a} = {b}, z, 0))"

    end = "substring({0}, length({0}) - p - z + 1, z)"
    rest = let(common("u", "substring(u.a, p + 1, z)", "substring(u.b, p + 1, z)"), "p",
               "named_struct('a', substring(u.a, p + 1), 'b', substring(u.b, p + 1), 'n', u.n - p)")
    middle = let(common("v", end.format("v.a"), end.format("v.b")), "p",
                 "named_struct('a', filter(split(substring(v.a, 1, length(v.a) - p), ''), c -> c != ''),"
                 " 'b', filter(split(substring(v.b, 1, length(v.b) - p), ''), c -> c != ''))")
    whole = f"named_struct('a', {la}, 'b', {lb}, 'n', least(length({la}), length({lb})))"
    return let(whole, "u", let(rest, "v", let(middle, "w", within("w.a", "w.b", edits))))


def _keyed(rows: DataFrame, places: list[tuple[int, int, int]], edits: int) -> DataFrame:
    """id, part, key, held, start, size of the substrings of texts (id, part, held, line, len) at ``places``.

    A place (shorter, i, shift) is where segment ``i`` of a text ``shorter``
    characters shorter would start, moved by ``shift``; segments are even, the
    later ones longer by one.  Only rows of one part meet.  ``held`` marks the
    own segments of a held text.  Places come as rows, so the code of one key
    is small and compiled once."""
    n = edits + 1
    listed = ", ".join(f"named_struct('shorter', {a}, 'i', {i}, 'shift', {d})" for a, i, d in places)
    cut = rows.select("id", "part", "held", "line", "len", F.expr(f"inline(array({listed}))")).where("len >= shorter")
    cut = cut.withColumn("other", F.expr("len - shorter")).withColumns({
        "start": F.expr(f"cast(i * (other div {n}) + greatest(0, i - {n} + other % {n}) + 1 + shift as int)"),
        "size": F.expr(f"cast(other div {n} + if(i >= {n} - other % {n}, 1, 0) as int)")})
    return cut.where("start >= 1 and start + size - 1 <= len").select(
        "id", "part", F.expr("xxhash64(part, other, i, substring(line, start, size))").alias("key"),
        F.expr("held and shorter = 0 and shift = 0").alias("held"), "start", "size")


def _rest(found: DataFrame, rows: DataFrame) -> DataFrame:
    """Texts without the segment or substring found in them, as a part of their own."""
    texts = rows.groupBy("id", "part", "line").agg(F.max("held")).select("id", "part", "line")
    line = F.expr("concat(substring(line, 1, start - 1), substring(line, start + size, length(line)))")
    rest = found.join(texts.join(_bounded(found.select("id").distinct()), "id", "leftsemi"), ["id", "part"]).select(
        "id", F.col("key").alias("part"), "held", line.alias("line"))
    return cut_lineage(rest.groupBy("id", "part", "line").agg(F.max("held").alias("held")).withColumn("len", F.length("line")))


def _later(pairs: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """Ids of the later line of those pairs (a, b) whose lines (id, line, at) are at most ``edits`` apart."""
    sides = [texts.select(F.col("id").alias(x), F.col("line").alias(f"l{x}"), F.col("at").alias(f"at_{x}")) for x in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b").where(f"abs(length(la) - length(lb)) <= {edits}")
    return both.where(close("la", "lb", edits)).select(F.expr("if(at_a < at_b, b, a)").alias("id")).distinct()


def _pairs(held: DataFrame, asked: DataFrame, most: int | None = None) -> DataFrame:
    """Pairs that share a key; with ``most``, only those whose ``grams`` differ in so many bits or fewer."""
    more = [] if most is None else ["grams"]
    met = held.select("key", F.col("id").alias("a"), *[F.col(c).alias("ga") for c in more]).join(
        asked.select("key", F.col("id").alias("b"), *[F.col(c).alias("gb") for c in more]), "key").where("a != b")
    if most is not None:
        met = met.where(f"bit_count(ga ^ gb) <= {most}")
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


#: Which of 64 classes of neighbouring characters occur an odd number of times in a text, as bits.  An edit takes
#: at most two such neighbours and makes at most two, so it changes four bits at most.
_GRAMS = ("aggregate(transform(array(filter(split(line, ''), c -> c != '')), c -> zip_with(c, slice(c, 2, greatest(size(c) - 1, 0)), "
          "(x, y) -> shiftleft(1L, cast(pmod(hash(x, y), 64) as int))))[0], 0L, (s, g) -> s ^ g)")


def late_lines(lines: DataFrame, edits: int = EDITS) -> DataFrame:
    """Ids of the distinct lines (id, line, at: their order; len if known) at most ``edits`` from an earlier one; each once.

    Lines that share a key with few others are paired with them.  In a crowd
    every line is first compared with the earliest of its key.  One found late
    is decided and asks no more, but stays for others to be compared with.  The
    undecided ones are paired with the lines of their key whose neighbouring
    characters differ in few classes.  Where that would take more than a fixed
    number of comparisons for each line of the input, counted beforehand, what
    is left of the crowd's lines is partitioned again."""
    if "len" not in lines.columns:
        lines = lines.withColumn("len", F.length("line"))
    rows = lines.select("id", F.lit(0).cast("long").alias("part"), F.lit(True).alias("held"), "line", "len")
    whole, places = [(0, i, 0) for i in range(edits + 1)], shifts(edits)
    met, late, texts, marks = [], None, None, None
    for level in range(LEVELS):
        held, asked = _keyed(rows, whole, edits).where("held"), _keyed(rows, places, edits)
        hot = cut_lineage(held.groupBy("key").count().where(F.col("count") > CROWD).select("key"))
        if hot.isEmpty():
            met.append(cut_lineage(_pairs(held, asked).distinct()))
            break
        hot = _bounded(hot)
        met.append(cut_lineage(_pairs(*(x.join(hot, "key", "leftanti") for x in (held, asked))).distinct()))
        crowd = cut_lineage(asked.join(hot, "key", "leftsemi"))
        if texts is None:
            texts = cut_lineage(lines.join(_bounded(crowd.select("id").distinct()), "id", "leftsemi").select("id", "line", "at"))
            marks = _bounded(texts.select("id", "at", F.expr(_GRAMS).alias("grams")))
        crowd = crowd.join(marks, "id")
        first = crowd.groupBy("key").agg(F.min(F.struct("at", "id")).alias("first")).select("key", F.col("first.id").alias("a"))
        tests = crowd.join(first, "key").select("a", F.col("id").alias("b")).where("a != b").distinct()
        if late is not None:
            tests = tests.join(late.withColumnRenamed("id", "b"), "b", "leftanti")
        found = _later(tests, texts, edits)
        late = _bounded(found if late is None else found.union(late))
        seen = cut_lineage(crowd.drop("at").join(late.withColumn("late", F.lit(True)), "id", "left").withColumn("open", F.expr("late is null")))
        thick = _bounded(seen.groupBy("key").agg(
            F.count("*").alias("n"), F.count_if("held").alias("h"), F.count_if("open").alias("o"),
            F.count_if(F.expr("open and held")).alias("x")).select("key", F.expr("x * n + o * h").alias("pairs"), "n").where(f"pairs > {CROWD} * n"))
        if level + 1 == LEVELS or (thick.agg(F.sum("pairs")).first()[0] or 0) <= COMPARISONS * lines.count():
            thick = thick.where("false")
        thin = seen.join(thick, "key", "leftanti")
        met.append(cut_lineage(_pairs(thin.where("held and open"), thin, 4 * edits).union(
            _pairs(thin.where("held and not open"), thin.where("open"), 4 * edits)).distinct()))
        again = cut_lineage(seen.join(thick, "key", "leftsemi"))
        if again.isEmpty():
            break
        rows = _rest(again, rows)
    pairs = met[0]
    for more in met[1:]:
        pairs = pairs.union(more)
    pairs = cut_lineage(pairs.distinct()) if len(met) > 1 else pairs
    ids = _bounded(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    found = _later(pairs, cut_lineage(lines.join(ids, "id", "leftsemi").select("id", "line", "at")), edits)
    return found if late is None else found.union(late).distinct()


#: What tells documents apart and orders them: id, then hashes of the text.
_DOC = ("doc_id", "t1", "t2")


def repeated_lines(docs: DataFrame, edits: int = EDITS, least_chars: int | None = None) -> DataFrame:
    """Numbers (from 0) of the lines to drop, for documents (doc_id, t1, t2, text) with any: doc_id, t1, t2, dropped (array)."""
    spark = docs.sparkSession
    near = LEAST_CHARS if least_chars is None else least_chars  # floor of the edit join
    counts = F.length("line") >= near
    if least_chars is None:
        counts = counts | F.col("line").rlike(r"(?U)\S")
    lines = docs.select(*_DOC, F.posexplode(F.split(text_of(), "\n", -1)).alias("no", "line")).where(counts)
    lines = lines.withColumns({"h1": F.xxhash64("line"), "h2": F.hash("line")})
    groups = lines.groupBy("h1", "h2").agg(F.min(F.struct(*_DOC, "no")).alias("first"), F.first("line").alias("line"), F.count("*").alias("n"))
    path = scratch_path(spark, "lines")
    # numbered as they are written: a number made anew by each later read would follow how files are split then
    groups.withColumns({"len": F.length("line"), "id": F.monotonically_increasing_id()}).write.parquet(path)
    distinct = spark.read.parquet(path)
    later = _bounded(late_lines(distinct.where(F.col("len") >= near).select("id", "line", "len", F.col("first").alias("at")), edits))
    verdict = distinct.select("id", "h1", "h2", "first", "n").join(later.withColumn("late", F.lit(True)), "id", "left").where("n > 1 or late")
    seen = lines.select(*_DOC, "no", "h1", "h2").join(_bounded(verdict.select("h1", "h2", "first", "late")), ["h1", "h2"])
    again = ~F.col("first").eqNullSafe(F.struct(*_DOC, "no"))
    return seen.where(F.coalesce("late", F.lit(False)) | again).groupBy(*_DOC).agg(F.collect_set("no").alias("dropped"))


def without_repeats(docs: DataFrame, edits: int = EDITS, least_chars: int | None = None, names: dict[str, str] | None = None) -> DataFrame:
    """``docs`` with all columns, ``text`` without its repeated lines, and n_lines, n_dropped (or as ``names`` has them).

    A line is dropped if an equal one occurs earlier: by doc_id (nulls first),
    hash of the text, line.  One of at least 30 characters is also dropped if
    another such line at most ``edits`` edits away occurs earlier.  Shorter
    lines of white space alone stay.  ``least_chars``, if given, is the floor
    of both rules, and every shorter line stays.  A null text stays null with no lines,
    an empty one has one empty line; repeated rows (same id and text) are one
    document and all keep its lines; a text whose every line goes becomes
    empty.  An empty table stays empty.
    """
    n_lines, n_dropped = ((names or {}).get(n, n) for n in ("n_lines", "n_dropped"))
    p = "__"
    while any(c.lower().startswith(p) for c in docs.columns):
        p += "_"
    docs = docs.withColumns({f"{p}t1": F.xxhash64("text"), f"{p}t2": F.hash("text")})
    dropped = _bounded(repeated_lines(docs.select("doc_id", F.col(f"{p}t1").alias("t1"), F.col(f"{p}t2").alias("t2"), "text"), edits, least_chars).select(
        *[F.col(c).alias(f"{p}d_{c}") for c in _DOC], F.col("dropped").alias(f"{p}dropped")))
    joined = docs.join(dropped, F.col("doc_id").eqNullSafe(F.col(f"{p}d_doc_id")) & (F.col(f"{p}t1") == F.col(f"{p}d_t1"))
                       & (F.col(f"{p}t2") == F.col(f"{p}d_t2")), "left")
    lines = F.split("text", "\n", -1)
    kept = F.expr("array_join(transform(filter(transform(split(text, '\n', -1), (x, i) -> struct(x, i)), "
                  f"l -> not array_contains({p}dropped, l.i)), l -> l.x), '\n')")
    return joined.withColumns({
        "text": F.when(F.col(f"{p}dropped").isNull(), F.col("text")).otherwise(kept),
        n_lines: F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)),
        n_dropped: F.when(F.col(f"{p}dropped").isNull(), 0).otherwise(F.size(f"{p}dropped"))}).drop(
        f"{p}t1", f"{p}t2", f"{p}dropped", *[f"{p}d_{c}" for c in _DOC])


def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` without repeated lines."""
    return without_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "text", "n_lines", "n_dropped")
