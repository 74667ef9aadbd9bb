"""Properties: normalisers are idempotent; parse gives the same answer as Python."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import sluice as S
from sluice.functions.columns import FLAG_FOUR_SYNONYMS

texts = st.lists(st.one_of(st.none(), st.text(alphabet=" \tabcYESNOtruefalsMALE_-/", max_size=8)), max_size=25)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=texts)
def test_normalisers_idempotent(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for f in (S.trim_spaces, S.upper_trim, lambda c: S.normalize_flag(c, FLAG_FOUR_SYNONYMS),
              lambda c: S.map_values(c, {"FEMALE": "F", "MALE": "M"}),
              lambda c: S.map_values(c, {"MILLIGRAMS": "mg"}, fallback="trim")):
        once = df.select(f("v").alias("v"))
        twice = once.select(f("v").alias("v"))
        assert [r.v for r in once.collect()] == [r.v for r in twice.collect()]


dates = st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2100, 12, 31))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(days=st.lists(st.tuples(dates, st.sampled_from(["%Y-%m-%d", "%d/%m/%Y", "%Y/%m/%d", "x"])), max_size=20))
def test_parse_date_matches_python(spark, days):
    rows = [(d.strftime(f) if f != "x" else "junk",) for d, f in days]
    df = spark.createDataFrame(rows, "v string")
    got = [r[0] for r in df.select(S.parse_date("v", ["yyyy-MM-dd", "dd/MM/yyyy"])).collect()]
    want = []
    for (d, f) in days:
        want.append(d if f in ("%Y-%m-%d", "%d/%m/%Y") else None)
    assert got == want


keys = st.one_of(st.none(), st.integers(min_value=0, max_value=6))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(child=st.lists(keys, max_size=30), parent=st.lists(keys, max_size=10))
def test_orphans_match_brute_force(spark, child, parent):
    c = spark.createDataFrame([(i, k) for i, k in enumerate(child)], "id long, fk long")
    p = spark.createDataFrame([(k,) for k in parent], "pk long")
    present = {k for k in parent if k is not None}
    want = sorted(i for i, k in enumerate(child) if k is None or k not in present)
    for kw in ({"strategy": "direct"}, {"strategy": "auto"}, {"strategy": "auto", "max_broadcast_keys": 1},
               {"strategy": "keys", "max_broadcast_keys": 0, "hot_key_rows": 2}):
        got = sorted(r.id for r in S.orphans(c, p, "fk", parent_key="pk", **kw).collect())
        assert got == want, kw


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.lists(st.tuples(keys, st.integers(0, 3), st.one_of(st.none(), st.sampled_from("abc"))), max_size=30))
def test_dedup_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "k long, o long, v string")
    best = {}
    for k, o, v in data:
        sort_key = (o, (v is not None, v or ""))  # order column, then the rest; nulls first
        if k not in best or sort_key < best[k][0]:
            best[k] = (sort_key, (k, o, v))
    want = sorted((row for _, row in best.values()), key=repr)
    for kw in ({"strategy": "shuffle"}, {"strategy": "duplicated"}):
        got = sorted((tuple(r) for r in S.dedup(df, ["k"], ["o"], **kw).collect()), key=repr)
        assert got == want, kw


FORMATS = {"yyyy-MM-dd": "%Y-%m-%d", "dd/MM/yyyy": "%d/%m/%Y", "yyyy/MM/dd": "%Y/%m/%d",
           "MM-dd-yyyy": "%m-%d-%Y", "yyyy.MM.dd": "%Y.%m.%d"}


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(accepted=st.lists(st.sampled_from(sorted(FORMATS)), min_size=1, max_size=3, unique=True),
       days=st.lists(st.tuples(dates, st.sampled_from(sorted(FORMATS))), max_size=15))
def test_parse_date_any_formats_match_python(spark, accepted, days):
    df = spark.createDataFrame([(d.strftime(FORMATS[f]),) for d, f in days], "v string")
    got = [r[0] for r in df.select(S.parse_date("v", accepted)).collect()]
    want = []
    for d, f in days:
        text = d.strftime(FORMATS[f])
        hit = None
        for a in accepted:  # first accepted format that reads the text back
            try:
                parsed = dt.datetime.strptime(text, FORMATS[a]).date()
            except ValueError:
                continue
            if parsed.strftime(FORMATS[a]) == text:
                hit = parsed
                break
        want.append(hit)
    assert got == want


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.text(alphabet=" abAB", max_size=4)), max_size=20),
       mapping=st.dictionaries(st.text(alphabet="AB", min_size=1, max_size=2), st.text(alphabet="xy", max_size=2),
                               max_size=20),
       fallback=st.sampled_from(["upper_trim", "trim", "keep"]))
def test_map_values_matches_python(spark, values, mapping, fallback):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(S.map_values("v", mapping, fallback=fallback)).collect()]

    def py(v):
        if v is None:
            return None
        key = v.strip(" ").upper()
        if key in mapping:
            return mapping[key]
        return {"upper_trim": key, "trim": v.strip(" "), "keep": v}[fallback]

    assert got == [py(v) for v in values]
