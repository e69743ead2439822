"""What several of the text operators share: reading, batches, columns set apart."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import siltstone

#: Rows of an Arrow batch; texts may be long, so far fewer than Spark's default.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ready_python(spark: SparkSession) -> None:
    """Get Python workers ready: small batches of a text table, and this package's code.

    Workers import the functions they run. On a cluster they have the package only if it is
    sent to them, which is done once an application; Spark keeps it for executors that come later.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(siltstone.__file__).parent
        place = Path(tempfile.mkdtemp(prefix="siltstone-code-")).resolve() / "siltstone.zip"
        with zipfile.ZipFile(place, "w") as packed:
            for source in sorted(package.rglob("*.py")):
                packed.write(source, source.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(place))
        _shipped.add(app)


def word_text(text: str | Column) -> Column:
    """A text column, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def set_apart(docs: DataFrame, used: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """docs with every column but the used ones renamed, and the new name of each.

    An operator that keeps all columns can then add its own under any name.
    """
    names = {c: c if c in used else f"_x{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items())), names


def put_back(df: DataFrame, names: dict[str, str], *added: str) -> DataFrame:
    """The columns that `set_apart` renamed, under their names, and added ones behind them."""
    return df.select(*(F.col(n).alias(c) for c, n in names.items() if c not in added), *added)


_KINDS = {
    "long": (T.LongType(), pa.int64()),
    "double": (T.DoubleType(), pa.float64()),
    "boolean": (T.BooleanType(), pa.bool_()),
    "string": (T.StringType(), pa.string()),
    "binary": (T.BinaryType(), pa.binary()),
    "array<long>": (T.ArrayType(T.LongType()), pa.list_(pa.int64())),
    "array<double>": (T.ArrayType(T.DoubleType()), pa.list_(pa.float64())),
    "array<string>": (T.ArrayType(T.StringType()), pa.list_(pa.string())),
}


def add_columns(
    df: DataFrame,
    keep: Sequence[str],
    inputs: Sequence[Column],
    make: Callable[[], Callable[..., Sequence[Sequence]]],
    added: dict[str, str],
) -> DataFrame:
    """The kept columns of df and columns made in Python, a row for a row.

    make runs once a task; what it returns gets the input columns of a batch as lists and
    returns the added columns as lists. Kept columns pass through untouched.
    """
    ready_python(df.sparkSession)
    n = len(keep)
    rows = df.select(*keep, *(c.alias(f"_in{i}") for i, c in enumerate(inputs)))
    schema = T.StructType(list(rows.schema)[:n])
    for name, kind in added.items():
        schema = schema.add(name, _KINDS[kind][0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            made = f(*(c.to_pylist() for c in batch.columns[n:]))
            new = [pa.array(v, _KINDS[k][1]) for v, k in zip(made, added.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *new], names=[*batch.schema.names[:n], *added])

    return rows.mapInArrow(run, schema)
