"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Most input of a task in steps that sort and hash their rows several times over: in memory
# these take some 30 times the bytes of the compressed files they come from.
SMALL_TASKS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
    "spark.sql.files.maxPartitionBytes": 32 << 20,
}
# Shuffle partitions that Spark joins to tasks of that size; fewer would leave larger ones.
PARTITIONS = 200
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def create(app_name: str = "siltstone", **conf: str) -> SparkSession:
    """Session for the jobs; the cluster's own settings stay unless given here."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Broadcasts are chosen by file size; rows in memory are larger than compressed files.
        .config("spark.sql.sources.fileCompressionFactor", "4.0")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return pin(builder.getOrCreate())


def pin(spark: SparkSession) -> SparkSession:
    """Options that results depend on, set on the session.

    Timestamps without an offset are read as UTC, whatever the host's zone. Of a key that
    a JSON object repeats, the last value counts; by default the object is unreadable.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Tasks of little input for what is planned and run inside.

    The number of tasks grows with the input then, and the memory of one does not. Settings
    that ask for smaller tasks or more partitions stay.
    """
    wanted = {k: str(v) for k, v in SMALL_TASKS.items() if v < _size(spark.conf.get(k))}
    given = spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")
    if int(given) < PARTITIONS:
        wanted[INITIAL_PARTITIONS] = str(PARTITIONS)
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _size(text: str) -> int:
    """Bytes of a size as Spark's settings give it, such as 64MB; a bare number is bytes."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", text.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by spark.checkpoint.dir."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        _check_shared(spark, named.rstrip("/"))
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="siltstone-")
    spark.sparkContext.setCheckpointDir(local)
    return local


_checked: set[tuple[str, str]] = set()


def _check_shared(spark: SparkSession, folder: str) -> None:
    """Once an application, see that executors read what the driver put in a file: folder.

    Other file systems are shared by nature, and in local mode there is one machine only.
    """
    app = spark.sparkContext.applicationId
    is_file = folder.startswith("file:") or "://" not in folder
    if (app, folder) in _checked or not is_file or spark.sparkContext.master.startswith("local["):
        return
    path = f"{folder}/siltstone/{app}/{uuid.uuid4().hex}/probe"
    files, place = file_system(spark, path)
    files.create(place).close()
    try:
        spark.read.format("binaryFile").load([path] * 8).select("length").collect()  # 8 empty files
    except Exception as error:
        raise RuntimeError(f"spark.checkpoint.dir is not shared with the executors: {folder}") from error
    finally:
        files.delete(place, False)
    _checked.add((app, folder))


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/siltstone/{spark.conf.get('spark.app.id')}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{_scratch_root(spark)}/{uuid.uuid4().hex}/{name}"


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = file_system(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    files, place = file_system(spark, path)
    files.delete(place, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application put below the shared folder, once nothing reads it."""
    remove(spark, _scratch_root(spark))
