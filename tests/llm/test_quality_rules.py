"""Quality rules against a plain reading of the definitions, and the host verdicts."""

import math
import re

from sluice.llm import quality_rules as Q


def canon(names, rows):
    """Rows in an order of their own, columns by name, NaN equal to itself."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    same = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(same(r[i]) for i in order) for r in rows), key=repr)


def measure(text, window=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = [tuple(words[i: i + window]) for i in range(len(words) - window + 1)]
    again = {j for i, r in enumerate(runs) if runs.count(r) > 1 for j in range(i, i + window)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again))


TEXTS = [
    None, "", " \t\n\x0b\x0c\r ", "one", "a b c d e", "a b c d e a b c d e", "a b c d e f a b c d e f a", "x " * 50, "é ü ö ß", "a\n\na\n \nb\na ",
    "# * $ %\n<b>|&</b>", "same line\nsame line\r\nsame line\n", "w " * 5 + "z", "p q " * 3 + "r s t u v w p q p q p", " ".join(f"w{i % 7}" for i in range(400)),
    " ".join(f"w{i}" for i in range(3000)) + " w1 w2 w3 w4 w5",
]


def test_measures_match_a_plain_reading(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    got = {r.i: tuple(r)[2:] for r in Q.measure(df).collect()}
    assert got == {i: measure(t) for i, t in enumerate(TEXTS)}


def test_bad_hosts_are_rejected_and_small_ones_are_shrunk(spark):
    good, bad = "plain words of a text " + " ".join(f"w{i}" for i in range(20)), "too short"
    rows = [(h, bad if i < n_bad else good) for h, n, n_bad in
            (("clean", 400, 4), ("spam", 300, 290), ("tiny", 1, 1), (None, 40, 0)) for i in range(n)]
    rows += [(f"h{k}", bad if i < 1 else good) for k in range(20) for i in range(30)]
    df = spark.createDataFrame([(i, t, h) for i, (h, t) in enumerate(rows)], "doc_id long, text string, source string")
    out = Q.quality_rules(df).collect()
    assert len(out) == len(rows)
    assert {r.source for r in out if r.host_rejected} == {"spam"}
    assert all(r.kept == (not r.base_failed and r.source != "spam") for r in out)
    assert any(r.base_failed and not r.host_rejected for r in out if r.source == "tiny")


def test_empty_tables_clashing_names_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert Q.quality_rules(empty).count() == 0
    df = spark.createDataFrame([(1, "a b", "s", "x", 7)] * 3, "doc_id long, text string, source string, kept string, _words int")
    out = Q.quality_rules(df).collect()
    assert [r.kept for r in out] == [False] * 3 and [r["_words"] for r in out] == [7] * 3


def test_query_matches_its_sql(spark, duck, sf):
    from sluice.llm import queries

    for name, sql in queries.oracle_sql().items():
        df, rel = queries.queries()[name](spark, sf), duck.sql(sql)
        assert sorted(df.columns) == sorted(rel.columns)
        assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(rel.columns, rel.fetchall()), name


def test_texts_are_read_twice_at_most(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [(i, "plain words of a text number " + str(i) * 3, f"h{i % 5}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").mapInArrow(count, "doc_id long, text string, source string")
    assert Q.quality_rules(docs).count() == 400 and seen.value <= 800
    seen.value = 0
    Q.quality_rules(docs).collect()
    assert seen.value == 800
    seen.value = 0
    Q.quality_rules(docs, carry_all=False).collect()
    assert seen.value == 400
