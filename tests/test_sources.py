import threading
from datetime import date, datetime, timezone

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.schemas import INGESTED_DATE, SILVER_VISITORS, Contract, TOP_PERFORMING_LOCATIONS
from siltstone.session import shared_dir
from siltstone.sources import partitions as P
from siltstone.sources import relational as R
from siltstone.sources import schema_history as H
from siltstone.sources.catalog import read_named
from siltstone.sources.staging import stage
from tests.conftest import plan, rows

D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


def frame(spark, *given):
    return spark.createDataFrame(list(given), "k string, n int")


def test_rewriting_a_date_keeps_the_others(spark, tmp_path):
    root = str(tmp_path / "t")
    assert P.write_partition(frame(spark, ("a", 1), ("b", 2)), root, D1) == 2
    assert P.write_partition(frame(spark, ("c", 3)), root, D2) == 1
    assert P.write_partition(frame(spark, ("z", 9)), root, D1) == 1
    assert rows(P.read_table(spark, root)) == [("c", 3, D2), ("z", 9, D1)]
    P.write_partition(frame(spark, ("z", 9)), root, D1)
    assert rows(P.read_table(spark, root)) == [("c", 3, D2), ("z", 9, D1)]


def test_empty_result_empties_its_date(spark, tmp_path):
    root = str(tmp_path / "t")
    P.write_partition(frame(spark, ("a", 1)), root, D1)
    P.write_partition(frame(spark, ("b", 1)), root, D2)
    assert P.write_partition(frame(spark, ("a", 1)).where("n > 5"), root, D1) == 0
    assert rows(P.read_partition(spark, root, D1)) == []
    assert rows(P.read_table(spark, root)) == [("b", 1, D2)]
    fresh = str(tmp_path / "fresh")
    assert P.write_partition(frame(spark, ("a", 1)).where("n > 5"), fresh, D1) == 0
    assert P.read_partition(spark, fresh, D1).columns == ["k", "n", INGESTED_DATE]


def test_missing_date_raises(spark, tmp_path):
    root = str(tmp_path / "t")
    P.write_partition(frame(spark, ("a", 1)), root, D1)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        P.read_partition(spark, root, D3)
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        P.read_dates(spark, root, [D1, D3])


def test_reading_a_date_touches_only_its_files(spark, tmp_path):
    root = str(tmp_path / "t")
    for day in (D1, D2, D3):
        P.write_partition(frame(spark, (str(day), 1)), root, day)
    one = P.read_partition(spark, root, D2)
    assert one.dtypes == [("k", "string"), ("n", "int"), (INGESTED_DATE, "date")]
    assert rows(one) == [(str(D2), 1, D2)]
    assert all(str(D2) in f for f in one.inputFiles())
    two = P.read_dates(spark, root, [D1, D3])
    assert sorted(r.k for r in two.collect()) == [str(D1), str(D3)]
    pruned = P.read_table(spark, root).where(F.col(INGESTED_DATE) == F.lit(D2))
    assert "PartitionFilters: [isnotnull(ingested_date" in plan(pruned)


def test_write_dates_replaces_only_dates_it_holds(spark, tmp_path):
    root = str(tmp_path / "t")
    many = spark.range(0, 300, 1, 8).select(
        F.col("id").cast("string").alias("k"),
        F.lit(1).alias("n"),
        F.expr("date_add(date'2024-01-01', cast(id % 3 as int))").alias(INGESTED_DATE),
    )
    assert P.write_dates(many, root) == 300
    files = list((tmp_path / "t").glob("ingested_date=*/*.parquet"))
    assert len(files) == 3
    again = many.where(F.col(INGESTED_DATE) == F.lit(D2)).withColumn("n", F.lit(2))
    assert P.write_dates(again, root) == 100
    sums = P.read_table(spark, root).groupBy(INGESTED_DATE).agg(F.sum("n"))
    assert rows(sums) == [(D1, 100), (D2, 200), (D3, 100)]


def test_whole_table_is_replaced(spark, tmp_path):
    root = str(tmp_path / "t")
    assert P.write_table(frame(spark, ("a", 1), ("b", 2)), root) == 2
    assert P.write_table(frame(spark, ("c", 3)), root) == 1
    assert rows(P.read_table(spark, root)) == [("c", 3)]
    with pytest.raises(ValueError, match="silver visitors: missing columns"):
        P.read_table(spark, root, SILVER_VISITORS)


def test_a_column_added_later_is_kept(spark, tmp_path):
    root = str(tmp_path / "t")
    P.write_partition(frame(spark, ("a", 1)), root, D1)
    P.write_partition(frame(spark, ("b", 2)).withColumn("x", F.lit("new")), root, D2)
    assert rows(P.read_table(spark, root).select("k", "x")) == [("a", None), ("b", "new")]
    typed = Contract("t", ("k",), types="k string, n int, x string, y double, ingested_date date")
    assert rows(P.read_table(spark, root, typed)) == [
        ("a", 1, None, None, D1),
        ("b", 2, "new", None, D2),
    ]


def test_a_date_of_other_types_is_refused(spark, tmp_path):
    root = str(tmp_path / "t")
    P.write_partition(frame(spark, ("a", 1)), root, D1)
    typed = Contract("t", ("k",), types="k string, n string, ingested_date date")
    with pytest.raises(ValueError, match="t: columns of another type: {'n': 'int'}"):
        P.read_partition(spark, root, D1, typed)
    with pytest.raises(ValueError, match="t: missing columns"):
        P.read_partition(spark, root, D1, Contract("t", ("z",), types="z int"))


def _records(root):
    return sorted(str(f.relative_to(root)) for f in root.glob("**/_schema-*"))


def test_dates_are_read_by_their_recorded_schemas(spark, tmp_path):
    """A wider number, a new column and an empty date; nothing is inferred from footers."""
    root = tmp_path / "t"
    P.write_partition(spark.createDataFrame([("a", 1, 1.5)], "k string, n int, x float"), str(root), D1)
    wide = spark.createDataFrame([("b", 1 << 40, 2.25, "new")], "k string, n long, x double, y string")
    P.write_partition(wide, str(root), D2)
    P.write_partition(wide.where("n < 0"), str(root), D3)
    assert len(_records(root)) == 3 and len({r.rsplit("-", 1)[1] for r in _records(root)}) == 2
    df = P.read_table(spark, str(root))
    assert df.dtypes == [("k", "string"), ("n", "bigint"), ("x", "double"), ("y", "string"), (INGESTED_DATE, "date")]
    assert rows(df) == [("a", 1, 1.5, None, D1), ("b", 1 << 40, 2.25, "new", D2)]
    assert len(H.groups(spark, str(root), H.date_folders(spark, str(root)))) == 2
    narrow = P.read_dates(spark, str(root), [D1])
    assert dict(narrow.dtypes)["n"] == "int"
    typed = Contract("t", ("k",), types="k string, n long, x double, y string, z date, ingested_date date")
    assert rows(P.read_table(spark, str(root), typed))[0] == ("a", 1, 1.5, None, None, D1)
    strict = Contract("t", ("k",), types="k string, n int, ingested_date date")
    with pytest.raises(ValueError, match="t: column n is bigint in some dates and int"):
        P.read_table(spark, str(root), strict)


def test_a_record_goes_with_its_date(spark, tmp_path):
    root = tmp_path / "t"
    P.write_partition(frame(spark, ("a", 1)), str(root), D1)
    P.write_partition(frame(spark, ("a", 1)).withColumn("x", F.lit(1)), str(root), D1)
    assert len(_records(root)) == 1
    assert rows(P.read_table(spark, str(root))) == [("a", 1, 1, D1)]
    P.write_table(frame(spark, ("a", 1)), str(tmp_path / "w"))
    P.write_table(frame(spark, ("a", 1)).select("k"), str(tmp_path / "w"))
    assert len(_records(tmp_path / "w")) == 1 and rows(P.read_table(spark, str(tmp_path / "w"))) == [("a",)]


def test_dates_of_other_writers_are_read_by_their_footers(spark, tmp_path):
    root = tmp_path / "t"
    P.write_partition(frame(spark, ("a", 1)), str(root), D1)
    other = spark.createDataFrame([("b", 5)], "k string, n long")
    other.write.parquet(str(root / f"ingested_date={D2}"))
    (root / f"ingested_date={D3}").mkdir()
    assert rows(P.read_table(spark, str(root))) == [("a", 1, D1), ("b", 5, D2)]
    spark.createDataFrame([("x", "y")], "k string, n string").write.parquet(str(root / "ingested_date=2024-01-04"))
    with pytest.raises(ValueError, match="column n is"):
        P.read_table(spark, str(root))


def test_types_widen_only():
    kinds = [T.IntegerType(), T.LongType(), T.DecimalType(10, 2), T.DecimalType(8, 6), T.DoubleType(), T.StringType()]
    assert H.wider(kinds[0], kinds[1]) == T.LongType()
    assert H.wider(kinds[2], kinds[3]) == T.DecimalType(14, 6)
    assert H.wider(T.DecimalType(38, 0), T.DecimalType(10, 9)) is None
    assert H.wider(T.FloatType(), T.DoubleType()) == T.DoubleType()
    assert all(H.wider(a, b) is None for a, b in [(kinds[1], kinds[4]), (kinds[0], kinds[5]), (kinds[2], kinds[4])])


def test_run_date(spark):
    assert P.run_date("2024-02-29") == date(2024, 2, 29)
    assert P.run_date() == datetime.now(timezone.utc).date()
    with pytest.raises(ValueError):
        P.run_date("2024-02-30")


def test_catalog_table(spark):
    frame(spark, ("a", 1)).createOrReplaceTempView("some_table")
    assert rows(read_named(spark, "some_table")) == [("a", 1)]
    with pytest.raises(ValueError, match="top_performing_locations: missing"):
        read_named(spark, "some_table", TOP_PERFORMING_LOCATIONS)


def test_stage_counts_and_reads_back(spark):
    staged = stage(frame(spark, ("a", 1), ("b", 2)), "t")
    assert staged.rows == 2 and rows(staged.df) == [("a", 1), ("b", 2)]
    assert stage(frame(spark, ("a", 1)).where("n > 5"), "t").rows == 0
    assert all(shared_dir(spark).removeprefix("file:") in f for f in staged.df.inputFiles())


# The database below lives inside this process (Derby ships with PySpark); no server runs.

DRIVER = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


@pytest.fixture(scope="module")
def database(spark):
    url = "jdbc:derby:memory:extract;create=true"
    keys = spark.createDataFrame(
        [(k, f"row {i}") for i, k in enumerate([*range(-25, 25), None, None, -(2**31), 2**31 - 1])],
        "k int, v string",
    )
    keys.write.jdbc(url, "order_items", mode="overwrite", properties=DRIVER)
    money = spark.createDataFrame([(1,)], "id int").select(
        "id", F.expr("cast(12.50 as decimal(10,2))").alias("price")
    )
    money.write.jdbc(url, "order_item_options", mode="overwrite", properties=DRIVER)
    return url


def test_whole_table_extract(spark, database):
    assert R.read_relational(spark, database, "order_items", DRIVER).count() == 54
    options = R.read_relational(spark, database, "order_item_options", DRIVER)
    assert options.dtypes[1][1] == "decimal(10,2)"


def test_hash_slices_read_each_row_once(spark, database):
    sliced = R.read_relational(spark, database, "order_items", DRIVER, hash_field="k")
    assert sliced.rdd.getNumPartitions() == R.HASH_PARTITIONS
    assert rows(sliced) == rows(R.read_relational(spark, database, "order_items", DRIVER))


def test_hash_conditions_by_dialect():
    assert R.hash_predicates("jdbc:sqlserver://h", "an id", 2) == [
        "ABS([an id] % 2) = 0 OR [an id] IS NULL",
        "ABS([an id] % 2) = 1",
    ]
    assert R.hash_predicates("jdbc:postgresql://h", "id", 1) == ['ABS(MOD("id", 1)) = 0 OR "id" IS NULL']
    text = R.hash_predicates("jdbc:postgresql://h", "code", 2, whole_numbers=False)
    assert text[1] == 'ABS(MOD(HASHTEXT(CAST("code" AS TEXT)), 2)) = 1'
    with pytest.raises(ValueError, match="no hash is known for derby"):
        R.hash_predicates("jdbc:derby:memory:x", "v", 2, whole_numbers=False)


def test_one_failing_table_does_not_stop_the_rest(spark, database, tmp_path):
    def read(table):
        return R.read_relational(spark, database, table, DRIVER)

    tables = ["order_items", "no_such_table", "order_item_options"]
    with pytest.raises(R.ExtractFailed, match="no_such_table") as failure:
        R.extract_tables(spark, tables, read, str(tmp_path))
    status = [tuple(r)[:3] for r in failure.value.status.collect()]
    assert status == [
        ("order_items", "ok", 54),
        ("no_such_table", "failed", None),
        ("order_item_options", "ok", 1),
    ]
    assert P.read_table(spark, f"{tmp_path}/order_items").count() == 54
    assert P.read_table(spark, f"{tmp_path}/order_item_options").count() == 1
    good = R.extract_tables(spark, ["order_items"], read, str(tmp_path))
    assert [tuple(r) for r in good.collect()] == [("order_items", "ok", 54, None)]


def test_failure_while_writing_is_a_failed_table(spark, tmp_path):
    bad = spark.range(3).select(F.raise_error(F.lit("lost connection")).cast("string").alias("x"))
    status = R.extract_tables(
        spark, ["t"], lambda _: bad, str(tmp_path), raise_on_failure=False
    ).first()
    assert status.status == "failed" and "lost connection" in status.error


def test_tables_are_copied_side_by_side(spark, tmp_path):
    """Two reads wait for each other; a table that fails stops none, and order is kept."""
    both = threading.Barrier(2, timeout=60)

    def read(table):
        if table == "bad":
            raise OSError("gone")
        both.wait()
        return spark.range(int(table[1:]))

    status = R.extract_tables(spark, ["t5", "bad", "t7"], read, str(tmp_path), raise_on_failure=False, at_once=3)
    assert [tuple(r) for r in status.collect()] == [("t5", "ok", 5, None), ("bad", "failed", None, "gone"), ("t7", "ok", 7, None)]
