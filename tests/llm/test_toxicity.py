"""The pattern grammar: its machine, what it learns, and held-out accuracy."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from sluice.llm import queries
from sluice.llm import toxicity as T

UNITS = {"idiot": "S", "fool*": "S", "silly": "W"}


def events(text):
    lexicon = T.Lexicon(UNITS)
    words = T.tokens_of(text)
    return [e for _, _, e in T.clauses_of([lexicon[w] for w in words])]


@pytest.mark.parametrize("text, patterns", [
    ("a plain clause. another one", []),
    ("what an idiot", [["S"]]),
    ("you idiot", [["S+"]]),
    ("you are not an idiot", [["S-+"]]),
    ("not one two three idiot", [["S"]]),  # beyond the reach of the negation
    ("he wrote that people are foolish", [["S'+"]]),
    ("he wrote it. Foolish", [["S"]]),  # reported speech ends with its clause
    ("idiot you", [["S", "A"]]),
    ("i will kill you", [["K", "T"]]),
    ("i will never hurt them", [["K-", "T-"]]),
    ("kill the process", [["K"]]),
    ("silly idiot! silly", [["W", "S"], ["W"]]),
    ("", []),
])
def test_clauses_match_patterns(text, patterns):
    assert events(text) == patterns


def test_composition_equals_running_the_parts():
    rng = random.Random(4)
    for _ in range(300):
        symbols = rng.choices("oSWKGNR", k=12)
        states, state = [s for s, _ in T.PATTERNS], 0
        for s in symbols:
            out = s
            for i, (_, step) in enumerate(T.PATTERNS):
                states[i], out = step(states[i], out)
            state, event = T.TABLE[state][s]
            assert event == (out if out[0] in "SWTKA" else "")


def test_prior_orders_clauses(spark):
    texts = ["you idiot", "an idiot", "not an idiot", "he said idiot", "good day"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in T.score_documents(df, T.Grammar(UNITS), clauses=True).collect()}
    scores = [got[i].score for i in range(5)]
    assert scores[0] > scores[1] > max(scores[2], scores[3]) > scores[4] and got[0].predicted == 1 and got[4].predicted == 0
    assert got[0].clauses[0].words == "you idiot" and got[0].clauses[0].patterns == ["S+"]


def made(n=900, seed=6):
    """Toxic texts hold made-up insults with two stems; each tenth text is a near copy."""
    rng = random.Random(seed)
    syllables = ["ba", "ke", "lo", "mi", "nu", "po", "ra", "si", "tu", "ve"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    rows = []
    for i in range(n):
        if i % 10 == 9:
            rows.append((i, rows[-1][1] + " " + word(), rows[-1][2]))
            continue
        words, toxic = [word() for _ in range(rng.randint(20, 60))], int(rng.random() < 0.15)
        for _ in range(rng.randint(2, 5) * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["zorg", "zorg" + word(), "quux"]))
        rows.append((i, " ".join(w + ("." if rng.random() < 0.1 else "") for w in words), toxic))
    return rows


def test_learns_stems_and_words_and_separates_held_out_rows(spark):
    rows = made()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(5, None), (None, 1), (10**6, 1)], "doc_id long, toxic int")
    g = T.learn(docs, labels)
    assert {"zorg*", "quux"} <= set(g.units) and all(u.strip("*")[0] in "zq" or "zorg" in u for u in g.units)
    got = {r.doc_id: r for r in T.score_documents(docs, g).collect()}
    out = [(got[i].predicted, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(out) > 150 and sum(p == y for p, y in out) >= 0.98 * len(out)


def test_rare_words_of_copies_are_no_insults(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choices(["aa", "bb", "cc", "dd", "ee"], k=30)) for _ in range(300)]
    rows = [(i, t, 0) for i, t in enumerate(texts)] + [(1000 + i, "quixotic umbrella sentence of one text aa bb", 1) for i in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    assert T.learn(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")).units == {}


def test_defined_results(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, "I will kill you", "x"), (3, "word " * 50000, "x"), (3, "word", "x")], "doc_id long, text string, score string")
    g = T.learn(df, none)
    assert g == T.Grammar()
    out = T.score_documents(df, g)
    assert out.columns == ["doc_id", "text", "score", "predicted"]
    got = out.collect()
    assert len(got) == 5 and len({r.score for r in got if r.doc_id is not None}) == 1
    assert [r.predicted for r in got if r.doc_id is None] == [1]
    assert T.score_documents(df.limit(0), g).count() == 0
    held = df.select("doc_id", T.held_out("doc_id").alias("h")).distinct().collect()
    assert {(r.doc_id, r.h) for r in held} == {(i, i is not None and zlib.crc32(str(i).encode()) % 4 == 2) for i in (1, 2, 3, None)}


def test_registered_query_on_held_out_labels(spark):
    import os

    sf = "/root/testdata/sf0.1"
    if not os.path.isdir(sf):
        pytest.skip("driver test data not present")
    out = queries.queries()["op13_toxicity"](spark, sf)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    found = out.join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic"), "doc_id").where("held_out")
    hit, missed, wrong, n = found.agg(F.count_if(F.expr("toxic = 1 and predicted = 1")), F.count_if(F.expr("toxic = 1 and predicted = 0")),
                                      F.count_if(F.expr("toxic = 0 and predicted = 1")), F.count("*")).first()
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    # Some rows labelled toxic hold no insult at all (repeated lines, tables, shouted prose), and two of the
    # invented languages' insult stems also begin plain words.
    assert hit >= 0.8 * (hit + missed) and wrong <= 0.01 * n, (hit, missed, wrong, n)
