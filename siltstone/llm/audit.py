"""How five filters of a corpus interact: what each removes in every order, alone or not.

Four filters judge a text by itself; the fifth asks whether a smaller doc_id has the same
text. A counting Bloom sketch comes before that: every text counts up a few cells of it, chosen
by its hash, the counters of all tasks are added, and a text with a cell that only it has
counted is in the table once. Only the other texts, possible repeats, are shuffled, and give
the exact smallest id of each full text. A row that is not the first of its text fails.

The flags of a row make a mask of five bits. Masks are counted by part, with the rows labelled
good and toxic, and these counts are all that the orders need: in an order a row is removed by
the first filter of it that the row fails, and over all orders each of m failed filters is the
first in 1 / m of them.

The sketch has CELLS cells or more for each text, as a power of 2; up to MOST cells, of which one
bit each goes to the tasks (256 MB at most). In a table of more than MOST / CELLS texts more
texts share cells, so more of them are shuffled; what comes out is exact in any case.

Defined cases: a null text counts as an empty one, a null lang is the part of the empty
string; rows without doc_id never fail the fifth filter and have no labels; rows of one doc_id
with one text don't make each other fail; a document with several labels is good (toxic) if
one says so; a text of any length is judged whole; columns other than doc_id, text and lang are
not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import ready_python, table, word_text
from siltstone.llm.words import mixed
from siltstone.sources.staging import stage

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]

LEAST_WORDS = 100
LEAST_DISTINCT = 80  # percent of the words
MOST_CAPITALS = 10  # percent of the characters
SIGNS = "[#$%&*|]"
SPACE = "[\\x20\\x09-\\x0D]+"

CELLS = 16
MOST = 1 << 31
HASHES = 4
_SLICE = 1 << 16  # cells that are added together
_HELD = 1 << 18  # texts that a task counts at a time

_SEEDS = mixed(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def own_failures(text: Column) -> list[Column]:
    """Whether a text fails each of the first four filters."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    return [
        n < LEAST_WORDS,
        100 * distinct < LEAST_DISTINCT * n,
        100 * capitals > MOST_CAPITALS * F.char_length(text),
        text.rlike(SIGNS),
    ]


def cells_of(hashes: np.ndarray, cells: int) -> np.ndarray:
    """The cells of some texts, a row a text."""
    return mixed(hashes.view(np.uint64)[:, None] ^ _SEEDS) & np.uint64(cells - 1)


def sketch(hashes: DataFrame, cells: int) -> np.ndarray:
    """Bits, one a cell: whether it was counted more than once. hashes: _hash of every row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def counted() -> pa.RecordBatch:
            found, times = np.unique(cells_of(np.concatenate(held), cells), return_counts=True)
            held.clear()
            slices = (found // _SLICE).astype(np.int32)
            starts = np.flatnonzero(np.diff(slices, prepend=-1))
            places = np.split((found % _SLICE).astype(np.uint16), starts[1:])
            times = np.split(np.minimum(times, 255).astype(np.uint8), starts[1:])
            rows = [slices[starts].tolist(), [p.tobytes() for p in places], [t.tobytes() for t in times]]
            types = [pa.int32(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=True)], names=["_slice", "_cells", "_times"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch.column(0).to_numpy())
            if sum(map(len, held)) >= _HELD:
                yield counted()
        if held:
            yield counted()

    def add(key: tuple, rows: pa.Table) -> pa.Table:
        total = np.zeros(_SLICE, dtype=np.uint8)
        for places, times in zip(rows["_cells"], rows["_times"], strict=True):
            at, more = np.frombuffer(places.as_py(), np.uint16), np.frombuffer(times.as_py(), np.uint8)
            total[at] = np.minimum(total[at].astype(np.uint16) + more, 255)
        bits = np.packbits(total > 1, bitorder="little").tobytes()
        return pa.table({"_slice": pa.array([key[0].as_py()], pa.int32()), "_bits": pa.array([bits], pa.binary())})

    parts = hashes.mapInArrow(count, "_slice int, _cells binary, _times binary")
    merged = parts.groupBy("_slice").applyInArrow(add, "_slice int, _bits binary").toArrow()  # MOST / 8 bytes at most
    out = np.zeros(max(cells, _SLICE) // 8, dtype=np.uint8)
    for at, bits in zip(merged["_slice"].to_pylist(), merged["_bits"].to_pylist(), strict=True):
        out[at * _SLICE // 8 : (at + 1) * _SLICE // 8] = np.frombuffer(bits, np.uint8)
    return out


def cells_for(texts: int) -> int:
    return min(MOST, 1 << max(1, CELLS * texts - 1).bit_length())


def with_flags(docs: DataFrame) -> DataFrame:
    """doc_id, part and mask of every row: bit i is set if the row fails filter i."""
    spark = docs.sparkSession
    ready_python(spark)
    text = word_text("text")
    own = sum((F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(own_failures(text))), F.lit(0))
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("lang", F.lit("")).alias("part"),
        own.alias("_own"),
        F.xxhash64(text).alias("_hash"),
    )
    narrow, rows = stage(narrow, "flags")
    cells = cells_for(rows)
    # One bit a cell, MOST bits at most.
    shared = spark.sparkContext.broadcast(sketch(narrow.select("_hash"), cells))

    @F.pandas_udf("boolean")
    def repeated(hashes: pd.Series) -> pd.Series:
        found = cells_of(hashes.to_numpy(), cells)
        return pd.Series((shared.value[found >> np.uint64(3)] >> (found & np.uint64(7)).astype(np.uint8) & 1).all(axis=1))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("_hash"))
    texts = texts.where(F.col("doc_id").isNotNull()).where(repeated("_hash"))
    firsts = texts.groupBy("_hash", "text").agg(F.min("doc_id").alias("doc_id"))
    firsts = stage(firsts.select("doc_id", "_hash").distinct().withColumn("_first", F.lit(True)), "firsts").df
    rows = narrow.withColumn("_repeat", repeated("_hash")).join(firsts, ["doc_id", "_hash"], "left")
    later = F.col("_repeat") & F.col("doc_id").isNotNull() & F.col("_first").isNull()
    return rows.select("doc_id", "part", (F.col("_own") + F.when(later, 16).otherwise(0)).alias("mask"))


def mask_counts(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows, good rows and toxic rows by part and mask; labels: doc_id, quality, toxic."""
    said = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1)).alias("_good"), F.max(F.when(F.col("toxic") == 1, 1)).alias("_toxic")
    )
    return flags.join(said, "doc_id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("n"),
        F.count("_good").alias("good"),
        F.count("_toxic").alias("toxic"),
    )


def by_order(counts: DataFrame) -> DataFrame:
    """What every step of every order keeps and removes; the counts of masks are all it reads."""
    mask, step, order = F.col("mask"), F.col("step"), F.col("filter_order")
    orders = counts.withColumn("filter_order", F.explode(F.array(*map(F.lit, ORDERS))))
    first = F.least(*(F.when(mask.bitwiseAND(1 << i) > 0, F.instr(order, f)) for i, f in enumerate(FILTERS)))
    orders = orders.withColumn("_first", first).withColumn("step", F.explode(F.array(*map(F.lit, range(1, 6)))))
    bit = F.expr(f"shiftleft(1, instr('{FILTERS}', substring(filter_order, step, 1)) - 1)")
    fails = mask.bitwiseAND(bit) > 0
    here = F.col("_first") == step

    def total(condition: Column, value: str | Column = "n") -> Column:
        return F.coalesce(F.sum(F.when(condition, value if isinstance(value, Column) else F.col(value))), F.lit(0))

    return orders.groupBy("part", "filter_order", "step").agg(
        total(F.col("_first").isNull() | (F.col("_first") > step)).alias("kept"),
        total(here).alias("removed"),
        total(fails & (F.col("_first") < step)).alias("redundant"),
        total(mask == bit).alias("unique_fails"),
        total(here, "good").alias("good_lost"),
        total(here, "toxic").alias("toxic_lost"),
        total(fails, F.expr(f"n * ({len(ORDERS)} DIV bit_count(mask))")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for every part, order and step."""
    return by_order(mask_counts(with_flags(docs), labels))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all labels."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH docs AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
        min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
    FROM documents
),
masks AS (
    SELECT doc_id, part,
        (CASE WHEN len(words) < 100 THEN 1 ELSE 0 END)
        + (CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END)
        + (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 4 ELSE 0 END)
        + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
        + (CASE WHEN doc_id > first_id THEN 16 ELSE 0 END) AS mask
    FROM docs
),
said AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
),
rows AS (
    SELECT part, mask, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM masks LEFT JOIN said USING (doc_id)
),
counts AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM rows GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
),
steps AS (
    SELECT filter_order, step, CAST(power(2, instr('ABCDE', substr(filter_order, step, 1)) - 1) AS INTEGER) AS bit,
        list_sum(list_transform(range(1, step), lambda k: CAST(power(2, instr('ABCDE', substr(filter_order, k, 1)) - 1) AS INTEGER))) AS before
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
),
judged AS (
    SELECT part, filter_order, step, n, good, toxic, mask, bit,
        (mask & bit) > 0 AS fails, (mask & CAST(coalesce(before, 0) AS INTEGER)) > 0 AS gone
    FROM counts, steps
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
    CAST(sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS BIGINT) AS kept,
    CAST(sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS BIGINT) AS removed,
    CAST(sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS BIGINT) AS redundant,
    CAST(sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
    CAST(sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END) AS BIGINT) AS good_lost,
    CAST(sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost,
    CAST(sum(CASE WHEN fails THEN n * 120 // bit_count(mask) ELSE 0 END) AS BIGINT) AS shapley
FROM judged GROUP BY part, filter_order, step
"""
