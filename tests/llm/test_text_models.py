"""Language identification, toxicity and line dedup."""

import os
import random
import re

import duckdb
import pyarrow as pa

from conftest import SF01
from corpus_frames import frame  # noqa: F401 - a fixture
from routecov.llm import language, line_dedup, toxicity


def test_language_backs_off_to_grams():
    model = language.Model(["de", "en"], [("en", 0, "the", 9), ("de", 0, "der", 9), ("en", 5, " hous", 3), ("de", 5, " haus", 3),
                                          ("en", 1, "w", 5), ("de", 1, "ü", 5)])
    assert model.word_cost("the")[1] < model.word_cost("the")[0] == language.PENALTY
    assert model.word_cost("houses")[1] < language.PENALTY == model.word_cost("houses")[0]
    assert model.word_cost("über")[0] < language.PENALTY
    assert (model.word_cost("日") == language.PENALTY).all()
    assert [x[0] for x in language.Scorer(model).score(["the houses", "der haus", "12 !!", "", None])] == ["en", "de", "und", "und", "und"]


def test_language_rows(frame):
    rnd = random.Random(1)
    vocab = {"de": ["der", "und", "nicht", "haus", "über"], "en": ["the", "and", "not", "house", "over"]}
    rows = [(i, " ".join(rnd.choice(vocab[g]) for _ in range(rnd.randint(1, 30))), g) for i in range(120) for g in [["de", "en"][i % 2]]]
    rows += [(500, None, "en"), (501, "", "de"), (502, "123 --", None), (503, "the house " * 20_000, None), (None, "und über", None), (0, "the", "en")]
    docs = frame(rows)
    model = language.train(docs.where("doc_id % 3 != 1"))
    got = {r.doc_id: r for r in language.predicted(docs, model, ["doc_id"]).collect()}
    assert all(got[i].lang_pred == g for i, _, g in rows[1:120])
    assert [got[i].lang_pred for i in (500, 501, 502, 503, None)] == ["und", "und", "und", "en", "de"]
    assert got[500].score == 0 and all(0 <= r.score <= 1 for r in got.values())
    empty = language.train(docs.limit(0))
    assert {r.lang_pred for r in language.predicted(docs, empty, ["doc_id"]).collect()} == {"und"}
    assert language.predicted(docs.limit(0), model, ["doc_id"]).collect() == []


def test_language_model_reaches_the_driver_as_columns(frame, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    docs = frame([(i, f"wort{i} haus der", "de") for i in range(40)] + [(i, f"word{i} house the", "en") for i in range(40, 80)])
    sizes, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: sizes.append(len(out := collect(self))) or out)
    model = language.train(docs)
    assert sizes == [2]  # languages; words and n-grams came as rows as well
    assert len(model.ids[0]) == 6 and model.cost.shape[1] == 2  # words are runs of letters
    assert model.word_cost("wort")[0] < model.word_cost("wort")[1] == language.PENALTY


def test_few_bytes_lie_in_few_partitions(spark):
    rows = spark.range(1000).repartition(48, "id")
    small = line_dedup._bounded(rows)
    assert small.rdd.getNumPartitions() == 1
    assert sorted(r.id for r in small.collect()) == list(range(1000))


def test_language_holds_no_whole_batch(frame, monkeypatch):
    """Texts become Python objects in steps, results leave in steps, and a kept text is sent to Python once."""
    monkeypatch.setattr(language, "STEP_CHARS", 20)
    texts = ["the houses", None, "der haus", "", "the " * 30, "haus", "der the the"]
    batch = pa.record_batch([pa.array(["en"] * 7), pa.array([t or "" for t in texts])], ["lang", "text"])
    steps = list(language._steps(batch, 1))
    assert pa.Table.from_batches(steps).to_pylist() == batch.to_pylist() and len(steps) == 3
    counted = {}
    for r in pa.Table.from_batches(language._counts(iter([batch]))).to_pylist():
        counted[r["n"], r["gram"]] = counted.get((r["n"], r["gram"]), 0) + r["c"]
    assert counted[0, "the"] == 33 and counted[5, " the "] == 33 and counted[0, "haus"] == 2
    model = language.Model(["de", "en"], [("en", 0, "the", 9), ("de", 0, "der", 9), ("en", 5, " hous", 3), ("de", 5, " haus", 3)])
    docs = frame(list(enumerate(texts)))
    got = language.predicted(docs, model, docs.columns)
    assert sorted((r.doc_id, r.text) for r in got.collect()) == list(enumerate(texts))
    assert "__text" not in got._jdf.queryExecution().toString()


def _chars(words):
    counts = {}
    for w in words:
        c = toxicity._codes(w)
        for a, b, d in zip(c[:-2], c[1:-1], c[2:]):
            key = int(a) << 12 | int(b) << 6 | int(d)
            counts[key] = counts.get(key, 0) + 1
    return toxicity.CharModel(list(counts.items())).log


def test_disguised_words_are_restored():
    log = _chars(["idiot", "stupid", "clown", "trash", "loser", "house", "window", "the", "and"] * 20)
    decoder = toxicity.Decoder(log)
    for text, word in [("you 1d10t!", "idiot"), ("5tup1d", "stupid"), ("see c l o w n here", "clown"), ("t.r.a.s.h", "trash"), ("l0o0ooser", "loser"),
                       ("looooser", "loser"), ("st*pid", "stupid"), ("$tup!d", "stupid"), ("idіоt", "idiot"), ("l-o-s-e-r", "loser")]:
        assert word in toxicity.hidden_words(text, decoder), (text, toxicity.hidden_words(text, decoder))
    assert toxicity.hidden_words("the house and window 12 a b", decoder) == set()


def test_disguises_of_any_length_and_mark_are_restored():
    log = _chars(["idiot", "stupid", "clown", "trash", "loser", "house", "window", "the", "and"] * 20)
    decoder = toxicity.Decoder(log)
    spelt = [x.join("idiot") for x in (*",/:·;#&'`", ", ", "   ", "\n", " \n\t ")]
    long = ["i" + "d" * 80 + "iot", "the-house-and-the-window-" * 3 + "1d10t", "the house " + " ".join("window" * 12 + "idiot"), "1d10t" + "-house" * 5000,
            "idiot".join(["a b c d " * 20, ""]).replace("idiot", "i d i o t")]
    for text in [*spelt, "iidiioott", "idiott", "ii dd ii oo tt", "1.d.1.0.t", "1.d.1.0.t", "* d i o t", "i d i o *", *long]:
        word = "dio" if "*" in text else "idiot"
        got = toxicity.hidden_words(text, decoder)
        assert any(word in w for w in got), (text[:100], sorted(got)[:20])
    assert decoder.restore("-" * 200_000 + "1d10t").strip() == "idiot"


class Counted(list):
    """A character model that counts its readers."""
    looks = 0

    def __getitem__(self, i):
        Counted.looks += 1
        return super().__getitem__(i)


def test_plain_stretches_are_not_searched():
    log = Counted(_chars(["bleerorthation", "the", "house"]))
    Counted.looks = 0
    assert toxicity.Decoder(log).restore("thebleerorthationhouse") in ("thebleerorthationhouse", "theblerorthationhouse")
    assert Counted.looks <= 4


def test_restored_tokens_are_the_best_readings():
    """Every token's reading is that of a search over all its characters."""
    log, rnd = _chars(["bleer", "the", "house", "offer", "ésel"]), random.Random(4)

    def best(token):
        paths = {(0, 0): (0.0, "")}
        for i, char in enumerate(token):
            nxt = {}
            for (a, b), (score, read) in paths.items():
                for out, cost, c in toxicity._options(token[i - 1] if i else "", char):
                    key = (a, b) if out == "" else (0, 0) if c == b == 0 else (b, c)
                    s = score - cost + (0.0 if key != (b, c) or out == "" or c == b == 0 else log[a][b][c])
                    if key not in nxt or s > nxt[key][0]:
                        nxt[key] = (s, read if out == "" or c == b == 0 else read + out)
            paths = nxt
        return max((s + (log[a][b][0] if b else 0.0), a, b, read) for (a, b), (s, read) in paths.items())[3]

    decoder = toxicity.Decoder(log)
    for _ in range(3000):
        token = "".join(rnd.choice("aabbeellosst*.-_0134$@!|%(²éñжое") for _ in range(rnd.randint(1, 12)))
        assert decoder.restore(token).strip() == best(token).strip(), token


def test_spaced_runs_are_found_in_any_text(monkeypatch):
    rnd = random.Random(5)
    texts = ["a b c d", "x.y.z", "a-a-a-a b", "k i l", "k* i", "* d i *", "ss  tt  u  v"]
    texts += ["".join(rnd.choice("aabb1 .* -,é") for _ in range(rnd.randint(1, 40))) for _ in range(2000)]
    got = [list(toxicity._spaced(t)) for t in texts]
    monkeypatch.setattr(toxicity, "_FOUR", re.compile(""))
    assert got == [list(toxicity._spaced(t)) for t in texts] and got[0] == ["a b c d"]


def test_toxicity_learns_words_and_scores_all_rows(spark, frame):
    rnd = random.Random(2)
    plain = [f"word{i}".translate(str.maketrans("0123456789", "abcdefghij")) for i in range(60)]
    rows, labels = [], []
    for i in range(400):
        words = [rnd.choice(plain) for _ in range(20)]
        toxic = i % 4 == 0
        if toxic:
            words[3] = rnd.choice(["idiot", "clown"])
            words[9] = rnd.choice(["1d1ot", "cl0wn", "c l o w n", "idioooot"])
        rows.append((i, " ".join(words)))
        labels.append((i, None, int(toxic)))
    rows += [(900, None), (901, ""), (902, "plain " * 30_000), (None, "idiot clown"), (5, rows[5][1])]
    labels += [(900, 1, 1), (None, 1, 1), (3000, 0, 0), (7, 0, None)]
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = frame(rows)
    scorer = toxicity.train(docs.where("doc_id % 5 != 0 or doc_id is null"), labelled.where("doc_id % 5 != 0"))
    got = toxicity.scored(docs, scorer, ["doc_id"]).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    by = {r.doc_id: r.predicted for r in got}
    assert all(by[i] == int(i % 4 == 0) for i in range(400)) and [by[i] for i in (900, 901, 902)] == [0, 0, 0]
    none = toxicity.train(docs, labelled.limit(0))
    assert {r.score for r in toxicity.scored(docs, none, ["doc_id"]).collect()} == {0.0}
    assert toxicity.scored(docs.limit(0), scorer, ["doc_id"]).collect() == []


def test_toxicity_held_out(spark):
    got = toxicity.op2_toxicity(spark, SF01)
    labels = spark.read.parquet(f"{SF01}/labels.parquet").select("doc_id", "toxic")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.toxic for r in rows) / len(rows)
    assert right >= 0.85, right


def test_language_held_out(spark):
    rows = language.op1_language(spark, SF01).join(spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang"), "doc_id").where(
        "held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) >= 0.98


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def near_set(seed):
    rnd, lines = random.Random(seed), set()
    for _ in range(25):
        base = "".join(rnd.choice("abé") for _ in range(rnd.randint(3, 14)))
        for _ in range(5):
            t = list(base)
            for _ in range(rnd.randint(0, 4)):
                i = rnd.randint(0, len(t))
                if rnd.random() < 0.5:
                    t.insert(i, rnd.choice("abé😀"))
                elif t:
                    t.pop(min(i, len(t) - 1))
            if len(t) >= 3:
                lines.add("".join(t))
    return sorted(lines)


def test_late_lines_equal_brute_force(spark, monkeypatch):
    lines = near_set(5)
    random.Random(3).shuffle(lines)  # the order has nothing to do with the text
    df = spark.createDataFrame([(i, (i,), x) for i, x in enumerate(lines)], "id long, at struct<n:long>, line string")
    for edits, crowd, comparisons in ((1, 8, 32), (2, 8, 32), (2, 2, 32), (2, 2, 0), (3, 8, 32)):
        monkeypatch.setattr(line_dedup, "CROWD", crowd)
        monkeypatch.setattr(line_dedup, "COMPARISONS", comparisons)
        want = {j for j in range(len(lines)) if any(distance(lines[i], lines[j]) <= edits for i in range(j))}
        got = [r.id for r in line_dedup.late_lines(df, edits).collect()]
        assert sorted(got) == sorted(want), (edits, crowd, comparisons)


def test_crowd_of_near_lines_is_decided_without_pairs(spark, monkeypatch):
    """Many versions of one line, those in the middle a step further from the first: nobody is lost, pairs stay linear."""
    base = "this line has been copied with small changes into very many documents"
    rnd, lines = random.Random(8), [base]
    while len(lines) < 200:
        t = list(rnd.choice(lines[:20]))
        t[rnd.randrange(len(t))] = rnd.choice("0123456789")
        if "".join(t) not in lines:
            lines.append("".join(t))
    made, real = [], line_dedup._later
    monkeypatch.setattr(line_dedup, "_later", lambda pairs, *more: made.append(pairs.count()) or real(pairs, *more))
    df = spark.createDataFrame([(i, (i,), x) for i, x in enumerate(lines)], "id long, at struct<n:long>, line string")
    got = sorted(r.id for r in line_dedup.late_lines(df).collect())
    assert got == [j for j in range(len(lines)) if any(distance(lines[i], lines[j]) <= 2 for i in range(j))]
    assert sum(made) < 200 * 199 / 2 / 4, made


def brute_lines(rows, edits, least):
    seen, out = {}, []  # ids differ here, so the order of documents is that of ids
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    for i in order:
        for no, line in enumerate((rows[i][1] or "").split("\n")):
            if len(line) >= least:
                seen.setdefault(line, (order.index(i), no))
    for place, i in enumerate(order):
        d, text = rows[i]
        if text is None:
            out.append((d, None, 0, 0))
            continue
        lines = text.split("\n")
        kept = [x for no, x in enumerate(lines)
                if len(x) < least or not any(at < (place, no) and distance(x, y) <= edits for y, at in seen.items())]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def test_lines_dropped_equal_brute_force(frame):
    rnd = random.Random(9)
    pool = near_set(6)
    rows = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(0, 6)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (None, pool[0] + "\n" + pool[1]), (103, "long line " * 3000), (104, "long line " * 3000 + "x")]
    got = line_dedup.without_repeats(frame(rows), edits=2, least_chars=5)
    assert sorted([(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()], key=str) == brute_lines(rows, 2, 5)
    assert {"lang", "size", "id"} <= set(got.columns)
    assert line_dedup.without_repeats(frame([])).collect() == []
    twice = line_dedup.without_repeats(frame([(1, "a line of some length"), (1, "a line of some length")], 1), least_chars=5).collect()
    assert [r.text for r in twice] == ["a line of some length"] * 2


def test_short_lines_go_when_equal(frame):
    short, other = "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-NC 3.0."
    rows = [(1, f"first own\n\n{short}\n \t"), (2, f"second own\n\n{short}\n \t"), (3, f"{other}\nx\nx\n\u3000\n\u3000"), (4, f"{short}\nx")]
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in line_dedup.without_repeats(frame(rows)).collect()}
    assert got == {1: (rows[0][1], 4, 0), 2: ("second own\n\n \t", 4, 1), 3: (f"{other}\nx\n\u3000\n\u3000", 5, 1), 4: ("", 2, 2)}


def test_line_dedup_leaves_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "x" * 40, 7, 8), (2, "x" * 41, 9, 10)], "doc_id long, text string, __t1 int, __dropped int")
    got = sorted(tuple(r) for r in line_dedup.without_repeats(df).select("doc_id", "text", "__t1", "__dropped").collect())
    assert got == [(1, "x" * 40, 7, 8), (2, "", 9, 10)]


def test_line_plan_is_native(spark, frame):
    df = line_dedup.without_repeats(frame([(1, "x" * 40), (2, "x" * 41)]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop"))


def test_near_duplicates_equal_their_sql_twin(spark):
    from routecov.llm.queries import QUERIES, SQL
    con = duckdb.connect()
    sf = os.path.dirname(SF01) + "/sf0.001"
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name, sql in SQL.items():
        got = QUERIES[name](spark, sf)
        res = con.execute(sql)
        cols = [d[0] for d in res.description]
        assert sorted(cols) == sorted(got.columns)
        assert sorted([tuple(r[c] for c in cols) for r in got.collect()], key=str) == sorted(res.fetchall(), key=str)


def test_line_numbers_do_not_follow_file_splits(spark, frame, monkeypatch):
    """The number of cores that files are split for changes in the middle of the run; each near repeat still goes, and no first line."""
    rnd = random.Random(12)
    first = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz ", k=50)) + f" {i}" for i in range(30)]
    rows = [(i, f"{a}\nown line {i}") for i, a in enumerate(first)] + [(500 + i, a[:20] + "Z" + a[21:]) for i, a in enumerate(first)]
    late = line_dedup.late_lines

    def then_more_cores(*args):
        ids = late(*args)
        spark.conf.set("spark.sql.files.minPartitionNum", "32")
        return ids
    monkeypatch.setattr(line_dedup, "late_lines", then_more_cores)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.doc_id: r.text for r in line_dedup.without_repeats(frame(rows, 9)).collect()}
    finally:
        for c in ("spark.sql.files.minPartitionNum", "spark.sql.adaptive.coalescePartitions.enabled"):
            spark.conf.unset(c)
    assert got == {**{i: rows[i][1] for i in range(30)}, **{500 + i: "" for i in range(30)}}


def test_twins_of_other_tables(spark):
    from routecov.llm.queries import QUERIES, SQL_OF_OTHER_TABLES
    con = duckdb.connect()
    sf = os.path.dirname(SF01) + "/sf0.001"
    for t in ("documents", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name, sql in SQL_OF_OTHER_TABLES.items():
        got = QUERIES[name](spark, sf)
        res = con.execute(sql)
        cols = [d[0] for d in res.description]
        assert sorted(cols) == sorted(got.columns)
        assert sorted([tuple(r[c] for c in cols) for r in got.collect()], key=str) == sorted(res.fetchall(), key=str)
