import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from siltstone import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session.create(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture()
def with_conf(spark):
    """Set SQL options for one test."""
    before = {}

    def put(**conf):
        for name, value in conf.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.set(key, value)


def rows(df):
    """Rows in a comparable order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    """Physical plan text; after an action it is the final one."""
    return df._jdf.queryExecution().executedPlan().toString()
