"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash of the last seven bytes ends a chunk wherever its low bits are all ones, so
that an edit moves only the chunk boundaries next to it. Each chunk gives one of 64 signs.
The number of bits, and with it the block size, is the text's own: about 64 chunks. A
fingerprint is block:signs:signs at twice the block. Two fingerprints are compared at a
block size that both have, by the edit distance of their signs.

Defined cases: a null text counts as empty, with the fingerprint "1::"; empty texts are
alike (1), an empty and another text are not (0); runs of more than three equal signs are
cut to three; rows of one doc_id go in the order of a hash of their text, rows without
doc_id last; the only document is its own next; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import ready_python, table, word_text
from siltstone.llm.words import encoded

LEAST_BITS = 0
FEW, MANY = 32, 128
BUCKETS_A_TASK = 4

_SIGNS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", dtype=np.uint8)
_FACTORS = [np.uint32(f) for f in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0xD3A2646D, 0xFD7046C5)]
_RUN = re.compile(r"(.)\1{3,}")


def _rolling(data: bytes) -> np.ndarray:
    """For every byte a hash of it and the six before."""
    x = np.frombuffer(data, dtype=np.uint8).astype(np.uint32) + np.uint32(1)
    h = x * _FACTORS[0]
    for back, factor in enumerate(_FACTORS[1:], start=1):
        h[back:] += x[:-back] * factor
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(12)
    return h


def _signature(rolling: np.ndarray, bits: int) -> str:
    ends = np.uint32((1 << bits) - 1)
    starts = np.flatnonzero((rolling & ends) == ends) + 1
    starts = np.concatenate(([0], starts[starts < len(rolling)]))
    sums = np.add.reduceat(rolling * np.uint32(0x9E3779B1), starts, dtype=np.uint32)
    signs = _SIGNS[(sums * np.uint32(0x85EBCA77)) >> np.uint32(26)]
    return _RUN.sub(r"\1\1\1", signs.tobytes().decode("ascii"))


def fingerprint(text: str) -> str:
    data = encoded(text)
    if not data:
        return f"{1 << LEAST_BITS}::"
    rolling = _rolling(data)
    bits = max(LEAST_BITS, (len(data) // 64).bit_length())
    signs = _signature(rolling, bits)
    while len(signs) < FEW and bits > LEAST_BITS:
        bits -= 1
        signs = _signature(rolling, bits)
    while len(signs) > MANY and bits < 30:
        bits += 1
        signs = _signature(rolling, bits)
    return f"{1 << bits}:{signs}:{_signature(rolling, bits + 1)}"


def edit_distance(a: str, b: str) -> int:
    """Insertions, deletions and replacements; the columns of the table are bits of numbers."""
    if not a or not b:
        return len(a) + len(b)
    at: dict[str, int] = {}
    for i, sign in enumerate(a):
        at[sign] = at.get(sign, 0) | 1 << i
    every, last = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, distance = every, 0, len(a)
    for sign in b:
        equal = at.get(sign, 0)
        diagonal = ((equal & up) + up ^ up) | equal | down
        right, left = down | ~(diagonal | up) & every, up & diagonal
        distance += bool(right & last) - bool(left & last)
        right, left = right << 1 | 1, left << 1
        keep = equal | down
        up, down = (left | ~(keep | right)) & every, right & keep & every
    return distance


def likeness(a: str, b: str) -> float:
    """0 to 1; 0 if the block sizes are not the same or twice one another."""
    if a == b:
        return 1.0
    (size_a, a1, a2), (size_b, b1, b2) = a.split(":"), b.split(":")
    if size_a == size_b:
        one, two = a1, b1
    elif int(size_a) == 2 * int(size_b):
        one, two = a1, b2
    elif 2 * int(size_a) == int(size_b):
        one, two = a2, b1
    else:
        return 0.0
    longest = max(len(one), len(two))
    return 1 - edit_distance(one, two) / longest if longest else 0.0


def _with_next(docs: DataFrame) -> DataFrame:
    """Texts dealt out by ranges of doc_id, each range followed by the first row of the next.

    Only the ranges' ends and their first rows pass through the driver, some for each shuffle
    partition; a text moves once, the first of a range twice.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), word_text("text").alias("text"))
    rows = rows.withColumn("_hash", F.xxhash64("text"))
    ranges = tasks * BUCKETS_A_TASK
    at = [k / ranges for k in range(1, ranges)]
    # The sketch behind the quantiles takes memory by its accuracy, not by the rows.
    quantiles = F.percentile_approx(F.col("doc_id").cast("long"), at, 20 * ranges)
    edges = np.unique(np.array(docs.agg(quantiles).first()[0] or [], dtype=np.int64))

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, ids.to_numpy(), side="right").astype(np.int32))

    own_range = place(F.coalesce(F.col("doc_id"), F.lit(0)))
    rows = rows.withColumn("_range", F.when(F.col("doc_id").isNull(), len(edges)).otherwise(own_range))
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_hash")
    firsts = rows.groupBy("_range").agg(F.min(key).alias("first")).orderBy("_range").collect()
    heads = [
        (r["first"]["doc_id"], r["first"]["_hash"], firsts[i - 1]["_range"]) for i, r in enumerate(firsts)
    ]
    # One row for each range.
    heads = F.broadcast(spark.createDataFrame(heads, "_head long, _head_hash long, _before int"))
    same = F.col("doc_id").eqNullSafe(F.col("_head")) & (F.col("_hash") == F.col("_head_hash"))
    own = F.struct(F.col("_range").alias("range"), F.lit(False).alias("tail"))
    also = F.struct(F.col("_before").alias("range"), F.lit(True).alias("tail"))
    places = F.when(F.col("_before").isNull(), F.array(own)).otherwise(F.array(own, also))
    rows = rows.join(heads, same, "left").withColumn("_at", F.explode(places))
    rows = rows.select(F.col("_at.range").alias("_range"), F.col("_at.tail").alias("_tail"), "doc_id", "_hash", "text")
    rows = rows.repartition(tasks, "_range")
    return rows.sortWithinPartitions("_range", "_tail", F.col("doc_id").asc_nulls_last(), "_hash")


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _RESULT.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    open_row: tuple[int | None, str, str] | None = None
    for batch in batches:
        out = []
        tails, ids, texts = (batch.column(c).to_pylist() for c in ("_tail", "doc_id", "text"))
        for tail, doc_id, text in zip(tails, ids, texts, strict=True):
            if tail and open_row is None:
                continue  # another copy of the next range's first row
            own = fingerprint(text)
            if open_row is not None:
                before_id, before, before_own = open_row
                n = len(before)
                edited = before[: n - n // 2] + text[: n // 2]
                changed = fingerprint(edited)
                sha = hashlib.sha256(encoded(edited)).hexdigest()
                near_edited, near_next = likeness(before_own, changed), likeness(before_own, own)
                out.append((before_id, n, sha, before_own, changed, near_edited, near_next))
            open_row = None if tail else (doc_id, text, own)
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def compared_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness."""
    ready_python(docs.sparkSession)
    return _with_next(docs).select("_tail", "doc_id", "text").mapInArrow(_compared, _RESULT)


def op5_piecewise_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against their edited text and the next document."""
    return compared_with_next(table(spark, sf_dir, "documents"))
