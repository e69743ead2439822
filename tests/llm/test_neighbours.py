import numpy as np
import pytest
from pyspark.sql import functions as F

from siltstone.llm import neighbours as N
from siltstone.llm.common import table
from tests.conftest import SMALL

MIDDLE = "/root/testdata/sf0.01"


def plain(rows, asked=lambda i: i % 100 == 0, k=10):
    """Every pair, components added from first to last."""
    rows = list({(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)})
    out = []
    for q, x in rows:
        if asked(q):
            scored = []
            for i, y in rows:
                if i != q and len(x) == len(y):
                    total = 0.0
                    for a, b in zip(x, y, strict=True):
                        total += (a - b) * (a - b)
                    scored.append((float(np.sqrt(total)), i))
            out += [(q, r, i, d) for r, (d, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("folder", [SMALL, MIDDLE])
def test_all_vectors(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in table(spark, folder, "embeddings").collect()]
    assert found(N.op13_block_neighbours(spark, folder)) == plain(rows)


def test_sql_gives_the_same(spark):
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{MIDDLE}/embeddings.parquet'")
    assert found(N.op13_block_neighbours(spark, MIDDLE)) == sorted(con.sql(N.OP13_SQL).fetchall())


def test_products_are_exact():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(-127, 128, (7, 3000)).astype(np.int8) for _ in range(2))
    a[0] = b[0] = 127
    assert (N.product(a, b) == a.astype(np.int64) @ b.astype(np.int64).T).all()


def test_bounds_hold():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 20)) * 10.0 ** rng.integers(-3, 4, (60, 1))
    x[30:] = x[:30] * (1 + 1e-9 * rng.normal(size=(30, 20)))
    side = N._Side(x)
    low, high = N.bounds(side, side, slice(0, 60), slice(0, 60))
    true = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    assert (low <= true).all() and (true <= high).all()


def test_many_blocks_copies_and_ties(spark):
    """A third of the rows one vector, many equal distances, blocks of 20 rows."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        v = [1.0, 0.0, 0.0, 0.0] if i % 3 == 0 else rng.integers(-2, 3, 4).astype(float).tolist()
        rows.append((i, v))
    rows += [(600, [1.0, 0.0, 0.0, 0.0]), (600, [1.0, 0.0, 0.0, 0.0]), (600, [2.0, 0.0, 0.0, 0.0]), (-30, [0.0, 0.0, 1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(N.nearest(df, F.col("vec_id") % 30 == 0, block=20)) == plain(rows, lambda i: i % 30 == 0)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (100, [1.0, 2.5]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]),
        (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 2.0]), (200, [0.0, 0.0]), (8, [1.0, 2.0, 3.0]), (300, [1.0, 2.0, 4.0]),
        (400, [1.0]), (9, [1e200, -1e200]), (500, [1e200, 1e200]), (600, [5e-324, 0.0]),
    ]
    df = spark.createDataFrame([(*r, 7, 7, 7) for r in rows], "vec_id long, embedding array<double>, rank int, _size long, _q int")
    assert found(N.nearest(df, F.col("vec_id") % 100 == 0)) == plain(rows)


def test_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert N.nearest(df, F.col("vec_id") % 100 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert N.nearest(one, F.col("vec_id") % 100 == 0).count() == 0
