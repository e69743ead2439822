"""The schema of every written date, kept beside its files, and reads by it.

A date's folder holds a small record next to the Parquet files; its name carries a hash of
the schema, so that listing the records tells which dates agree. A table is read by groups of
dates with one schema, with casts that widen only, and no footer is opened to find out the
columns. A record goes when its date is replaced; a date without one (as other writers
leave it, or a run that failed between files and record) has its own footers read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.schemas import INGESTED_DATE, Contract
from siltstone.session import file_system

RECORD = "_schema-"

# From narrow to wide; a value of a type is one of the types behind it, too.
CHAINS = (
    (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()),
    (T.FloatType(), T.DoubleType()),
)


def record(spark: SparkSession, folder: str, schema: T.StructType) -> None:
    """Put the record of a schema into a folder of files just written."""
    text = schema.json().encode()
    files, place = file_system(spark, f"{folder}/{RECORD}{hashlib.sha256(text).hexdigest()[:32]}")
    out = files.create(place, True)
    out.write(bytearray(text))
    out.close()


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a pattern, those of hidden files included."""
    files, place = file_system(spark, pattern)
    return sorted(status.getPath().toString() for status in files.globStatus(place) or ())


def _recorded(spark: SparkSession, path: str) -> T.StructType:
    files, place = file_system(spark, path)
    stream = files.open(place)
    try:
        return T.StructType.fromJson(json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def wider(one: T.DataType, two: T.DataType) -> T.DataType | None:
    """The type that holds the values of both unchanged; None if neither chain has one."""
    if one == two:
        return one
    for chain in CHAINS:
        if one in chain and two in chain:
            return max(one, two, key=chain.index)
    if isinstance(one, T.DecimalType) and isinstance(two, T.DecimalType):
        scale = max(one.scale, two.scale)
        precision = scale + max(one.precision - one.scale, two.precision - two.scale)
        return T.DecimalType(precision, scale) if precision <= 38 else None
    return None


def united(table: str, schemas: Sequence[T.StructType], fixed: T.StructType | None = None) -> T.StructType:
    """Columns of all schemas with types that hold every schema's values; fixed types must."""
    found: dict[str, T.DataType] = {f.name: f.dataType for f in fixed or ()}
    promised = set(found)
    for schema in schemas:
        for field in schema:
            known = found.get(field.name, field.dataType)
            both = wider(known, field.dataType)
            if both is None or (field.name in promised and both != known):
                raise ValueError(
                    f"{table}: column {field.name} is {field.dataType.simpleString()} in some dates"
                    f" and {known.simpleString()} in others or by contract"
                )
            found[field.name] = both
    return T.StructType([T.StructField(name, kind) for name, kind in found.items()])


def groups(spark: SparkSession, root: str, folders: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Folders by schema: from their records, one of each kind being read, else from their own footers."""
    records: dict[str, list[str]] = {}
    for path in listed(spark, f"{root}/{INGESTED_DATE}=*/{RECORD}*"):
        folder, name = path.rsplit("/", 1)
        records.setdefault(_date_of(folder), []).append(name)
    schemas: dict[str, T.StructType] = {}
    out: dict[str, tuple[T.StructType, list[str]]] = {}
    for folder in folders:
        names = records.get(_date_of(folder), ())
        if len(names) == 1:
            if names[0] not in schemas:
                schemas[names[0]] = _recorded(spark, f"{folder}/{names[0]}")
            schema = schemas[names[0]]
        elif not listed(spark, f"{folder}/*.parquet"):
            if not listed(spark, folder):
                spark.read.parquet(folder)  # raises PATH_NOT_FOUND
            continue
        else:
            schema = spark.read.option("mergeSchema", "true").parquet(folder).schema
        out.setdefault(schema.json(), (schema, []))[1].append(folder)
    return list(out.values())


def _date_of(folder: str) -> str:
    return folder.rsplit("/", 1)[1]


def date_folders(spark: SparkSession, root: str) -> list[str]:
    """The folders of a table's dates; none for a table without dates."""
    return listed(spark, f"{root.rstrip('/')}/{INGESTED_DATE}=*")


def read_dated(
    spark: SparkSession, root: str, folders: Sequence[str], contract: Contract | None = None
) -> DataFrame | None:
    """Some dates of a table as one frame, ingested_date last; None if no folder tells a schema."""
    root = root.rstrip("/")
    parts = groups(spark, root, folders)
    if not parts:
        return None
    fixed = contract.schema if contract else None
    target = united(contract.table if contract else root, [schema for schema, _ in parts], _undated(fixed))
    frames = []
    for schema, paths in parts:
        df = spark.read.schema(schema).option("basePath", root).parquet(*paths)
        there = {f.name: f.dataType for f in schema}
        columns = [
            (F.col(f"`{f.name}`") if there.get(f.name) == f.dataType else F.col(f"`{f.name}`").cast(f.dataType)).alias(f.name)
            if f.name in there
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target
        ]
        frames.append(df.select(*columns, INGESTED_DATE))
    out = frames[0]
    for more in frames[1:]:
        out = out.union(more)
    return out


def read_undated(spark: SparkSession, root: str) -> DataFrame:
    """A whole table by its record, or else with the columns of all its files."""
    names = listed(spark, f"{root.rstrip('/')}/{RECORD}*")
    if len(names) == 1:
        return spark.read.schema(_recorded(spark, names[0])).parquet(root)
    return spark.read.option("mergeSchema", "true").parquet(root)


def _undated(schema: T.StructType | None) -> T.StructType | None:
    return schema and T.StructType([f for f in schema if f.name != INGESTED_DATE])
