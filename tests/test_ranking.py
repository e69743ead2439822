import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from siltstone.operators.ordering import in_order
from siltstone.operators.ranking import best_of_each, exact_quantiles, largest, rank_within
from tests.conftest import plan, rows


def _values(kind):
    rng = random.Random(11)
    if kind == "spread":
        return [round(rng.random() * 1e6, 2) for _ in range(3000)]
    if kind == "ties":
        return [rng.choice([0.0, 0.0, 0.0, 5.5, 7.25, float(rng.randrange(40))]) for _ in range(3000)]
    if kind == "skewed":
        return [rng.paretovariate(0.6) for _ in range(2501)]
    return [4.0] * 700


@pytest.mark.parametrize("kind", ["spread", "ties", "skewed", "equal"])
def test_quantiles_equal_percentile(spark, kind):
    values = _values(kind)
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
    shares = [0.0, 1 / 3, 0.5, 2 / 3, 0.999, 1.0]
    direct = df.where("NOT isnan(x)").agg(F.percentile("x", shares)).first()[0]
    assert exact_quantiles(df, "x", shares) == pytest.approx(direct, rel=1e-15)


def test_quantiles_of_nothing(spark):
    assert exact_quantiles(spark.createDataFrame([], "x double"), "x", [0.5, 0.6]) == [None, None]
    none = spark.createDataFrame([(None,)], "x double")
    assert exact_quantiles(none, "x", [0.5]) == [None]
    one = spark.createDataFrame([(2.5,)], "x double")
    assert exact_quantiles(one, "x", [0.0, 0.3, 1.0]) == [2.5, 2.5, 2.5]


@pytest.mark.parametrize("kind", ["spread", "ties", "skewed", "equal"])
def test_ranks_equal_the_window(spark, kind):
    rng = random.Random(5)
    odd = [None, float("nan"), float("inf"), -0.0, 0.0]
    data = [
        (i, rng.choice(["EUR", "EUR", "USD", None]), v if rng.random() > 0.05 else rng.choice(odd))
        for i, v in enumerate(_values(kind))
    ]
    df = spark.createDataFrame(data, "id int, currency string, x double")
    window = Window.partitionBy("currency").orderBy(F.desc("x"))
    plain = df.withColumn("rank", F.rank().over(window).cast("int"))
    ranked = rank_within(df, "currency", "x", "rank")
    assert list(map(repr, rows(ranked))) == list(map(repr, rows(plain)))
    assert ranked.columns == plain.columns


def test_ranks_have_no_window_over_a_whole_group(spark):
    df = spark.createDataFrame([(i, "EUR", float(i % 97)) for i in range(500)], "id int, c string, x double")
    text = plan(rank_within(df, "c", "x", "rank"))
    assert "rank(" not in text
    windows = [line for line in text.splitlines() if "windowspecdefinition" in line]
    assert windows and all("c#" not in line.split("windowspecdefinition")[1] for line in windows)


def test_running_sums_over_all_rows(spark):
    rng = random.Random(9)
    data = [(i, rng.choice("abc"), rng.randrange(10)) for i in range(2000)]
    df = spark.createDataFrame(data, "i int, g string, n long").repartition(7)
    got = in_order(df, [F.col("g"), F.col("i")], "t", "n").orderBy("rank").collect()
    expected, total = sorted(data, key=lambda r: (r[1], r[0])), 0
    for place, (row, want) in enumerate(zip(got, expected, strict=True)):
        assert (row.i, row.rank, row.before, row.total) == (want[0], place, total, 2000)
        total += want[2]
    assert {r.whole for r in got} == {total}


def test_largest_breaks_ties_and_takes_top_k(spark):
    df = spark.createDataFrame(
        [("b", 5), ("a", 5), ("c", 5), ("d", 9), ("e", None), ("f", 1)], "o string, n int"
    )
    top = largest(df, "n", "o", 3)
    assert [tuple(r) for r in top.collect()] == [("b", 5), ("a", 5), ("d", 9)]
    assert "TakeOrderedAndProject" in plan(top)
    assert largest(df, "n", "o", 10).count() == 6


def test_rank_ties_share_a_rank(spark):
    df = spark.createDataFrame([("x", 3.0), ("x", 3.0), ("x", 1.0)], "g string, v double")
    ranks = rank_within(df, "g", "v", "r").select("v", "r")
    assert rows(ranks) == [(1.0, 3), (3.0, 1), (3.0, 1)]
    assert dict(ranks.dtypes)["r"] == "int"


def test_best_of_every_group_in_one_pass(spark):
    rng = random.Random(3)
    data = [(i, rng.choice(["EUR", "EUR", "USD", None]), rng.choice([None, *range(40)])) for i in range(900)]
    df = spark.createDataFrame(data, "id int, c string, r int").repartition(6)
    best = best_of_each(df, "c", "r", "id", 10)
    want = {}
    for i, c, r in data:
        if c is not None:
            want.setdefault(c, []).append((r is None, r or 0, i))
    assert sorted(map(tuple, best.select("c", "id").collect())) == sorted((c, i) for c, own in want.items() for _, _, i in sorted(own)[:10])
    text = plan(best)
    below = text[text.index("Exchange") :]
    assert "WindowGroupLimit" in below  # each task cuts its groups before rows move
