"""Runs of a dated job for every date that needs one: never run, or run on other files.

A run over a date leaves a small record in the output's folder of that date; its name carries
a fingerprint of the input's files. Listings of both sides tell which dates are missing or
changed, without reading a row. A record goes with its date when that is replaced, so a run
that failed before its end is tried again.
"""

from __future__ import annotations

import hashlib
import logging
from datetime import date

from pyspark.sql import SparkSession

from siltstone.plans.jobs import JOBS, Report, run
from siltstone.session import file_system
from siltstone.sources.partitions import partition_path
from siltstone.sources.schema_history import date_folders, listed

log = logging.getLogger(__name__)

RECORD = "_inputs-"


def fingerprint(spark: SparkSession, folders: list[str]) -> str:
    """A hash of the names, sizes and times of the data files of some folders."""
    found = []
    for i, folder in enumerate(folders):
        files, place = file_system(spark, folder)
        for status in files.listStatus(place):
            name = status.getPath().getName()
            if not name.startswith(("_", ".")):
                found.append(f"{i}/{name}:{status.getLen()}:{status.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()[:32]


def _dates(spark: SparkSession, root: str) -> set[date]:
    return {date.fromisoformat(folder.rsplit("=", 1)[1]) for folder in date_folders(spark, root)}


def pending(spark: SparkSession, name: str, root: str) -> dict[date, str]:
    """The dates that a job has to run for, with the fingerprints of their inputs.

    A date counts once all inputs of the job have it; others are named in the log.
    """
    job, root = JOBS[name], root.rstrip("/")
    if job.whole:
        raise ValueError(f"{name} reads all dates at once")
    dates = [_dates(spark, f"{root}/{table}") for table, _ in job.inputs]
    ready = set.intersection(*dates)
    for day in sorted(set.union(*dates) - ready):
        log.warning("%s: %s is not there in all inputs", name, day)
    done = {}
    for path in listed(spark, f"{root}/{job.output}/*/{RECORD}*"):
        folder, record = path.rsplit("/", 2)[1:]
        done.setdefault(folder, set()).add(record.removeprefix(RECORD))
    out = {}
    for day in sorted(ready):
        current = fingerprint(spark, [partition_path(f"{root}/{table}", day) for table, _ in job.inputs])
        if done.get(partition_path("", day).lstrip("/")) != {current}:
            out[day] = current
    return out


def backfill(spark: SparkSession, name: str, root: str, **options: object) -> dict[date, Report]:
    """Run a job for its missing and changed dates, oldest first; the reports by date."""
    reports = {}
    for day, current in pending(spark, name, root).items():
        reports[day] = run(spark, name, root, day, **options)
        target = partition_path(f"{root.rstrip('/')}/{JOBS[name].output}", day)
        files, place = file_system(spark, f"{target}/{RECORD}{current}")
        files.create(place, True).close()
    return reports
