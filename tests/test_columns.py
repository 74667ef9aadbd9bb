"""Column builders on tiny frames: nulls, padding, tabs, bad dates, bad numbers."""

import datetime as dt

from pyspark.sql import functions as F

import sluice as S
from sluice.functions.columns import FLAG_FOUR_SYNONYMS, FLAG_TWO_SYNONYMS, date_shape


def one_col(spark, values, t="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {t}")


def vals(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_trim_spaces_keeps_tabs_and_case(spark):
    df = one_col(spark, ["  a B  ", "x\t", None, "\tq "])
    assert vals(df, S.trim_spaces("v")) == ["a B", "x\t", None, "\tq"]


def test_upper_trim(spark):
    df = one_col(spark, [" site_b ", "site_a", None, "SITE_C\t"])
    assert vals(df, S.upper_trim("v")) == ["SITE_B", "SITE_A", None, "SITE_C\t"]


def test_map_values_upper_fallback(spark):
    df = one_col(spark, ["Female", " male ", "f", None, "other"])
    got = vals(df, S.map_values("v", {"FEMALE": "F", "MALE": "M"}))
    assert got == ["F", "M", "F", None, "OTHER"]


def test_map_values_trim_fallback_keeps_case(spark):
    df = one_col(spark, ["milligrams", " mg/day ", "MilliGrams ", "mg"])
    got = vals(df, S.map_values("v", {"MILLIGRAMS": "mg"}, fallback="trim"))
    assert got == ["mg", "mg/day", "mg", "mg"]


def test_map_values_large_mapping(spark):
    mapping = {f"K{i}": f"v{i}" for i in range(40)}
    df = one_col(spark, ["k3", " K39 ", "zz", None])
    assert vals(df, S.map_values("v", mapping)) == ["v3", "v39", "ZZ", None]


def test_flags(spark):
    df = one_col(spark, ["YES", " true", "no", "False", "y", "maybe", None])
    assert vals(df, S.normalize_flag("v", FLAG_FOUR_SYNONYMS)) == ["Y", "Y", "N", "N", "Y", "MAYBE", None]
    assert vals(df, S.map_values("v", FLAG_TWO_SYNONYMS)) == ["YES", "Y", "NO", "N", "Y", "MAYBE", None]


def test_date_shape():
    assert date_shape("yyyy-MM-dd") == r"^\d{4}-\d{2}-\d{2}\z"
    assert date_shape("dd/MM/yyyy") == r"^\d{2}/\d{2}/\d{4}\z"
    assert date_shape("yyyy.MM.dd") == r"^\d{4}\.\d{2}\.\d{2}\z"
    assert date_shape("dd MMM yyyy") is None


def test_parse_date_first_hit_wins_and_bad_is_null(spark):
    df = one_col(spark, ["2025-03-15", "15/03/2025", "2025-3-5", "2025-02-30", "2025-03-15 10:00:00",
                         " 2025-03-15 ", "2025.03.15", "", None, "2025-03-15\n"])
    got = vals(df, S.parse_date("v", ["yyyy-MM-dd", "dd/MM/yyyy"]))
    d = dt.date(2025, 3, 15)
    assert got == [d, d, None, None, None, None, None, None, None, None]


def test_parse_date_other_formats(spark):
    df = one_col(spark, ["03-18-2025", "2025/05/20", "2025.07.11"])
    assert vals(df, S.parse_date("v", ["yyyy-MM-dd", "MM-dd-yyyy"]))[0] == dt.date(2025, 3, 18)
    assert vals(df, S.parse_date("v", ["yyyy/MM/dd"]))[1] == dt.date(2025, 5, 20)
    assert vals(df, S.parse_date("v", ["yyyy-MM-dd", "yyyy.MM.dd"]))[2] == dt.date(2025, 7, 11)


def test_to_double(spark):
    df = one_col(spark, [" 5.5 ", "1e3", "NaN", "not_available", "", None, "-2"])
    got = vals(df, S.to_double("v"))
    assert got[0] == 5.5 and got[1] == 1000.0 and got[2] != got[2]
    assert got[3:] == [None, None, None, -2.0]


def test_to_int_truncates(spark):
    df = one_col(spark, [1987.0, 7.9, -7.9, None, float("nan"), 1e12], "double")
    assert vals(df, S.to_int("v")) == [1987, 7, -7, None, None, None]


def test_range_and_conditional_flags(spark):
    df = spark.createDataFrame([(3.0, "A"), (10.0, "B"), (60.0, "A"), (None, None)], "v double, s string")
    assert vals(df, S.range_flag("v", 7, 56)) == ["Y", "N", "Y", "N"]
    assert vals(df, S.flag_when((F.col("s") == "A") & (F.col("v") > 5))) == ["N", "N", "Y", "N"]


def test_round_half_even(spark):
    df = one_col(spark, ["2.675", "2.665", "2.6751", "-1.005"], "string")
    got = vals(df, S.round_half_even(F.col("v").cast("decimal(10,4)"), 2).cast("double"))
    assert got == [2.68, 2.66, 2.68, -1.0]


def test_format_id_keeps_wide_numbers(spark):
    df = one_col(spark, [7, 123, 123456], "long")
    assert vals(df, S.format_id("v", "P", 4)) == ["P0007", "P0123", "P123456"]


def test_dates_offset_and_text(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 1, 30, 23, 59), 3), (dt.datetime(2025, 3, 1), -5)],
                               "ts timestamp_ntz, n int")
    assert vals(df, S.date_text(S.add_days("ts", F.col("n")))) == ["2025-02-02", "2025-02-24"]


def test_starts_with_null_is_false(spark):
    df = one_col(spark, ["P0001", "X1", None, "p2"])
    assert vals(df, S.starts_with("v", "P")) == [True, False, False, False]


def test_key_text(spark):
    df = spark.createDataFrame([(1, 2), (3, None)], "a long, b int")
    assert vals(df, S.key_text(["a", "b"])) == ["1|2", "3|\\N"]
    assert vals(df, S.key_text(["a"])) == ["1", "3"]
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a\\", "|c"), ("\\N", None)], "a string, b string")
    got = vals(df, S.key_text(["a", "b"]))
    assert got == ["a\\|b|c", "a|b\\|c", "a\\\\|\\|c", "\\\\N|\\N"] and len(set(got)) == 4


def test_parse_date_optional_section(spark):
    df = one_col(spark, ["2025-01-02", "2025-01-02 10:00", "x", None])
    assert [str(v) for v in vals(df, S.parse_date("v", ["yyyy-MM-dd[ HH:mm]"]))] == ["2025-01-02", "2025-01-02", "None", "None"]


def test_map_values_null_target_at_any_size(spark):
    df = one_col(spark, ["n/a", "V1", "zz", None])
    for n in (1, 40):
        mapping = {"N/A": None, **{f"V{i}": f"v{i}" for i in range(n + 1)}}
        assert vals(df, S.map_values("v", mapping)) == [None, "v1", "ZZ", None]


def test_same_results_with_ansi_off(spark):
    df = one_col(spark, ["2025-03-15", "15/03/2025", "2025-02-30", "junk", " 5.5 ", "1e3", "NaN", None])
    exprs = [S.parse_date("v", ["yyyy-MM-dd", "dd/MM/yyyy"]).alias("d"), S.to_double("v").alias("x"),
             S.to_int(S.to_double("v")).alias("i")]

    def run():
        return [tuple("nan" if isinstance(x, float) and x != x else x for x in r) for r in df.select(*exprs).collect()]

    before = spark.conf.get("spark.sql.ansi.enabled")
    try:
        spark.conf.set("spark.sql.ansi.enabled", "true")
        on = run()
        spark.conf.set("spark.sql.ansi.enabled", "false")
        off = run()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert on == off


def test_map_values_keep_and_null_fallbacks(spark):
    df = one_col(spark, [" a ", "B", None])
    assert vals(df, S.map_values("v", {"A": "x"}, fallback="keep")) == ["x", "B", None]
    assert vals(df, S.map_values("v", {"A": "x"}, fallback="null")) == ["x", None, None]
    assert vals(df, S.map_values("v", {})) == ["A", "B", None]
