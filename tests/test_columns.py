from datetime import datetime

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from siltstone.functions import columns as C
from siltstone.operators.filters import in_list, sorted_values, where_selected
from tests.conftest import plan, rows


def _texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "i int, t string")


def _apply(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_timestamps(spark):
    df = _texts(
        spark, "2024-01-02T03:04:05Z", "2024-01-02T03:04:05.123+02:00", "2024-01-02", "nope", None
    )
    got = _apply(df, C.parse_timestamp(F.col("t")).cast("timestamp_ntz"))
    assert got == [
        datetime(2024, 1, 2, 3, 4, 5),
        datetime(2024, 1, 2, 1, 4, 5, 123000),
        datetime(2024, 1, 2),
        None,
        None,
    ]


def test_booleans_and_doubles(spark):
    df = _texts(spark, "true", "yes", "1", "no", "maybe", None)
    assert _apply(df, C.parse_boolean(F.col("t"))) == [True, True, True, False, None, None]
    df = _texts(spark, "1.5", "x", "", None)
    assert _apply(df, C.parse_double(F.col("t"))) == [1.5, None, None, None]


def test_mentions(spark):
    df = _texts(spark, None, "FaceBook ad", "facebook+YouTube", "other")
    assert _apply(df, C.mentions(F.col("t"), "facebook")) == [0, 1, 1, 0]
    assert _apply(df, C.mentions(F.col("t"), "youtube")) == [0, 0, 1, 0]


def test_blank_is_null_or_spaces(spark):
    df = _texts(spark, None, "", "  ", "\t", "u")
    assert _apply(df, C.is_blank(F.col("t"))) == [True, True, True, False, False]
    urls = _apply(df, C.default_url(F.col("t"), F.lit("m1"), "http://b/"))
    assert urls == ["http://b/m1"] * 3 + ["\t", "u"]
    assert _apply(df, C.default_url(F.col("t"), F.lit(None), "http://b/"))[0] is None


def test_whole_counts(spark):
    df = _texts(spark, "3.9", "-3.9", "x", None, " 12 ", "nan", "1d", "1e3", "2F")
    assert _apply(df, C.whole_count(df, "t")) == [3, -3, 0, 0, 12, 0, 0, 1000, 0]
    numbers = spark.createDataFrame([(0, 2.7), (1, None), (2, float("nan"))], "i int, t double")
    assert _apply(numbers, C.whole_count(numbers, "t")) == [2, 0, 0]
    whole = spark.createDataFrame([(0, 2**53 + 1), (1, None)], "i int, t bigint")
    assert _apply(whole, C.whole_count(whole, "t")) == [2**53 + 1, 0]
    exact = whole.select("i", (F.col("t").cast("decimal(20,0)") + F.lit(0.5).cast("decimal(2,1)")).alias("t"))
    assert _apply(exact, C.whole_count(exact, "t")) == [2**53 + 1, 0]


# Texts near the edge of what is a number.
NUMBER_TEXTS = """1_000 0x10 +5 5. .5 . 1e400 -1e400 True 1,000 --1 1e e5 inf -inf Infinity +inf INF infinity
NaN nan NA None null 1d 1D 2f 0x1p3 1e5f 00012 1E3 1e+3 -0 5- 1.2.3 9007199254740993 0.1 1e-400 infd
1L 0b11 +-5 inff e 1e+ 3.e2""".split() + ["", " ", "\t7\n", " 8", "1 2", "- 5", " +7 ", "\r9", "١", "１２"]


def test_numbers_in_text_equal_pandas(spark):
    expected = pd.to_numeric(pd.Series(NUMBER_TEXTS, dtype=object), errors="coerce")
    df = _texts(spark, *NUMBER_TEXTS)
    got = _apply(df, C.lenient_number(df, "t"))
    assert got == [None if x != x else x for x in expected]


def test_infinite_count_raises(spark):
    df = _texts(spark, "inf")
    with pytest.raises(PySparkException, match="CAST_OVERFLOW"):
        _apply(df, C.whole_count(df, "t"))


def test_percent_rounding_equals_python(spark):
    pairs = [(c, n) for n in range(1, 260) for c in range(n + 1)]
    pairs += [(107, 4000), (1, 32), (1, 3200), (2675, 100_000), (5, 100_000), (1, 10**9)]
    df = spark.createDataFrame(pairs, "c bigint, n bigint")
    share = C.percent(F.col("c"), F.col("n"))
    got = df.select("c", "n", C.round_percent(share).alias("p")).collect()
    wrong = [r for r in got if r.p != round(r.c / r.n * 100, 2)]
    assert wrong == []


def test_percent_of_nothing(spark):
    row = spark.range(1).select(C.percent(F.lit(0), F.lit(0)).alias("p"))
    assert row.select(C.round_percent(F.col("p"))).first()[0] == 0.0


def test_run_stamp(spark):
    stamp = C.run_stamp(F.lit(datetime(2024, 1, 2, 3, 4, 5)))
    assert spark.range(1).select(stamp).first()[0] == "2024-01-02_03-04-05"


def test_rename_raises_where_it_would_be_silent(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert C.rename(df, "a", "c").columns == ["c", "b"]
    assert C.rename(df, "z", "c", optional=True).columns == ["a", "b"]
    with pytest.raises(ValueError, match="no column 'z'"):
        C.rename(df, "z", "c")
    with pytest.raises(ValueError, match="'b' already exists"):
        C.rename(df, "a", "b")


def test_changes_apply_to_present_columns_only(spark):
    df = spark.createDataFrame([("1", "2")], "a string, b string")
    changed = C.transform_present(df, {"a": C.parse_double, "zz": C.parse_double})
    assert changed.dtypes == [("a", "double"), ("b", "string")]
    assert C.drop_present(df, ["b", "zz"]).columns == ["a"]


@pytest.mark.parametrize(
    "chosen,expected",
    [
        (["High"], ["High"]),
        (["High", None], ["High", None]),
        ([None], [None]),
        ([], []),
        (["none of these"], []),
    ],
)
def test_in_list_with_nulls(spark, chosen, expected):
    df = spark.createDataFrame([("High",), ("Low",), (None,)], "s string")
    got = [r[0] for r in df.where(in_list(F.col("s"), chosen)).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    rest = [r[0] for r in df.where(~in_list(F.col("s"), chosen)).collect()]
    assert len(got) + len(rest) == 3


def test_default_selection_is_the_first_value(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("a", 4)], "s string, n int")
    assert rows(where_selected(df, "s")) == [("a", 2), ("a", 4)]
    assert rows(where_selected(df, "s", "b")) == [("b", 1)]
    assert [r[0] for r in sorted_values(df, "s").collect()] == ["a", "b"]
    assert "CartesianProduct" not in plan(where_selected(df, "s"))
