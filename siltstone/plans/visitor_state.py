"""The visitor dimension kept in hash buckets, of which a date's update touches only its own.

    parts/bucket=B/ingested_date=D    what date D says of the visitors of bucket B
    state/bucket=B                    the parts of all dates, merged

A date's first run merges its part into the state of its visitors' buckets and reads no other
date. A rerun cannot take back what its earlier run merged, so it rebuilds the buckets that the
date was in from their parts. Either way other buckets are neither read nor written.

A run that fails may be repeated: the parts come first, and a bucket with a part of the date is
rebuilt. Parts that a rerun no longer has go last, when the state is without them.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone import session
from siltstone.operators.aggregates import merge_known
from siltstone.plans import gold
from siltstone.schemas import INGESTED_DATE
from siltstone.sources import partitions
from siltstone.sources.schema_history import listed

#: A date with few visitors for each bucket leaves most buckets alone; more buckets mean more small files.
BUCKETS = 256

BUCKET = "bucket"
STATE = (
    "visitor_key string, ip struct<at: timestamp, value: string>, "
    "country struct<at: timestamp, value: string>, bucket int"
)


def update(spark: SparkSession, root: str, events: DataFrame, day: date, buckets: int = BUCKETS) -> set[int]:
    """Replace what a date says of its visitors and return the buckets that were rewritten."""
    root = root.rstrip("/")
    _keep_count(spark, root, buckets)
    of_day = f"{INGESTED_DATE}={day.isoformat()}"
    before = _numbers(listed(spark, f"{root}/parts/{BUCKET}=*/{of_day}"))
    bucket = F.pmod(F.xxhash64("visitor_key"), F.lit(buckets)).cast("int").alias(BUCKET)
    part = gold.visitor_first_seen(events).select("*", bucket, F.lit(day).alias(INGESTED_DATE))
    now = _replace(part, f"{root}/parts", BUCKET, INGESTED_DATE)
    gone = before - now
    known = _numbers(listed(spark, f"{root}/state/{BUCKET}=*"))

    sources = []
    if fresh := now - before:
        parts = _read(spark, f"{root}/parts", _folders(f"{root}/parts", fresh, f"/{of_day}"))
        sources.append(parts.drop(INGESTED_DATE))
    if merged := fresh & known:
        sources.append(_read(spark, f"{root}/state", _folders(f"{root}/state", merged)))
    if before:
        dates = _read(spark, f"{root}/parts", _folders(f"{root}/parts", before), f"{STATE}, {INGESTED_DATE} date")
        left = (F.col(INGESTED_DATE) != F.lit(day)) | ~F.col(BUCKET).isin(sorted(gone))
        sources.append(dates.where(left).drop(INGESTED_DATE))
    if not sources:
        return set()
    rows = reduce(DataFrame.unionByName, sources)
    state = merge_known(rows, [BUCKET, "visitor_key"], gold.VISITOR_ATTRIBUTES)
    written = _replace(state, f"{root}/state", BUCKET)
    for folder in _folders(f"{root}/state", (before & known) - written):
        session.remove(spark, folder)
    for folder in _folders(f"{root}/parts", gone, f"/{of_day}"):
        session.remove(spark, folder)
    return now | before


def dimension(spark: SparkSession, root: str) -> DataFrame:
    """One row per visitor of all dates; equals gold.dim_visitor over all their events."""
    root = root.rstrip("/")
    if listed(spark, f"{root}/state/{BUCKET}=*"):
        state = _read(spark, f"{root}/state", [f"{root}/state"])
    else:
        state = spark.createDataFrame([], STATE)
    return gold.as_dimension(state.drop(BUCKET))


def _read(spark: SparkSession, base: str, folders: list[str], schema: str = STATE) -> DataFrame:
    return spark.read.schema(schema).option("basePath", base).parquet(*folders)


def _replace(df: DataFrame, root: str, *by: str) -> set[int]:
    """Replace the folders that the frame has rows for and return their buckets."""
    checked, seen = partitions.counted(df.hint("rebalance", BUCKET), F.collect_set(BUCKET).alias("buckets"))
    (
        checked.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(root)
    )
    return set(seen.get["buckets"]) if partitions.rows_seen(seen) else set()


def _numbers(folders: Iterable[str]) -> set[int]:
    return {int(folder.split(f"/{BUCKET}=", 1)[1].split("/", 1)[0]) for folder in folders}


def _folders(root: str, buckets: Iterable[int], below: str = "") -> list[str]:
    return [f"{root}/{BUCKET}={b}{below}" for b in sorted(buckets)]


def _keep_count(spark: SparkSession, root: str, buckets: int) -> None:
    """Note the number of buckets, which must stay: another one would deal visitors elsewhere."""
    note = f"{root}/_buckets-{buckets}"
    there = listed(spark, f"{root}/_buckets-*")
    if not there:
        files, place = session.file_system(spark, note)
        files.create(place, True).close()
    elif [path.rsplit("/", 1)[1] for path in there] != [note.rsplit("/", 1)[1]]:
        raise ValueError(f"{root} has another number of buckets than {buckets}: {there}")
