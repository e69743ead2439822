"""Sharding along a Hilbert curve.

Several metadata dimensions are quantised to cells of about equal row counts, rows are
sorted by the index of their cell on the Hilbert curve, and the sorted rows are cut into
runs. Rows near each other in every dimension land in the same run, so that a reader who
filters on any of the dimensions skips most files by their minima and maxima.

Defined cases: a null falls into the first cell of its dimension; a null text has size 1
and the checksum of no bytes, 0; equal places on the curve go by checksum, then by doc_id;
repeated rows each get a slot; an empty table gives an empty result. Other columns are
kept by `shards` unless they bear the name of a column it adds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm.common import put_back, ready_python, set_apart, table
from siltstone.operators.ordering import in_order
from siltstone.sources.staging import TEXT_ROWS, stage

SHARDS = 16
BITS = 6
DIMENSIONS = ("lang", "source", "size", "doc_id")
ADDED = ["size", "text_crc32", "curve", "law", "shard", "slot", "grown_shard"]


def curve_index(cells: Sequence[np.ndarray], bits: int) -> np.ndarray:
    """Index on the Hilbert curve of integer cells, one array for each dimension.

    Skilling's transform: undo the excess rotations from the highest bit down, Gray-encode,
    then interleave the bits of the dimensions.
    """
    x = [np.asarray(c, dtype=np.int64).copy() for c in cells]
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(len(x)):
            turned = (x[i] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            index = (index << 1) | (((axis ^ flip) >> bit) & 1)
    return index


def cuts(df: DataFrame, dimension: str, bits: int) -> list:
    """At most 2**bits - 1 ascending values at which the cells of a dimension begin.

    Numbers are cut at approximate quantiles. Text is cut by counting its distinct values
    and adding the counts up in their order, so that a frequent value gets cells of its own.
    """
    cells = 1 << bits
    kind = df.schema[dimension].dataType
    if isinstance(kind, T.NumericType):
        at = [k / cells for k in range(1, cells)]
        found = df.agg(F.percentile_approx(F.col(dimension).cast("double"), at, 10_000)).first()[0]
        return sorted(set(found or []))
    values = df.where(F.col(dimension).isNotNull()).groupBy(F.col(dimension).cast("string").alias("_value"))
    values = in_order(values.agg(F.count("*").alias("_rows")), [F.col("_value")], "cuts", "_rows")
    cell = ((F.col("before") + F.col("_rows") / 2) * cells / F.col("whole")).cast("int")
    firsts = values.groupBy(cell.alias("_cell")).agg(F.min("_value").alias("_value")).collect()  # 2**bits rows at most
    return sorted(r["_value"] for r in firsts)[1:]


def curve_column(df: DataFrame, dimensions: Sequence[str], bits: int) -> Column:
    """A row's index on the curve; the cut points are a few values of each dimension."""
    ready_python(df.sparkSession)
    edges = [cuts(df, d, bits) for d in dimensions]

    def place(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in parts:
            cells = []
            for values, edge in zip(columns, edges, strict=True):
                known = values.notna().to_numpy()
                cell = np.zeros(len(values), dtype=np.int64)
                if edge and known.any():
                    own = np.array(edge, dtype=object if isinstance(edge[0], str) else float)
                    cell[known] = np.searchsorted(own, values[known].to_numpy(dtype=own.dtype), side="right")
                cells.append(cell)
            yield pd.Series(curve_index(cells, bits))

    numeric = {d: isinstance(df.schema[d].dataType, T.NumericType) for d in dimensions}
    args = [F.col(d).cast("double" if numeric[d] else "string") for d in dimensions]
    return F.pandas_udf(place, "long")(*args)


def with_size(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    added = {"size": F.octet_length(text).cast("long") + 1, "text_crc32": F.crc32(F.encode(text, "UTF-8"))}
    return docs.drop(*ADDED).withColumns(added)


def cut_runs(placed: DataFrame, count: int, most: int | None = None) -> DataFrame:
    """Rows with a curve index, at most so many, cut into runs that differ by one row at most (law "rows")."""
    order = [F.col(c) for c in ("curve", "text_crc32", "doc_id")]
    rows = in_order(placed, order, "curve", most=most, each=TEXT_ROWS)
    rows = rows.withColumns({"law": F.lit("rows"), "shard": F.expr(f"rank * {count} div total").cast("int")})
    first = F.expr(f"(shard * total + {count - 1}) div {count}")
    rows = rows.withColumns({"slot": F.col("rank") - first, "grown_shard": F.lit(None).cast("int")})
    return rows.drop("rank", "total")


def shards(
    docs: DataFrame, count: int = SHARDS, dimensions: Sequence[str] = DIMENSIONS, bits: int = BITS
) -> DataFrame:
    """docs with size, text_crc32, curve, law, shard, slot and grown_shard.

    The statistics read a narrow table; the rows themselves are sorted and written once.
    """
    own, names = set_apart(docs, ["doc_id", "text", *dimensions])
    sized = with_size(own)
    narrow = stage(sized.select(*dimensions), "dimensions")
    rows = cut_runs(sized.withColumn("curve", curve_column(narrow.df, dimensions, bits)), count, narrow.rows)
    return put_back(rows, names, *ADDED)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard; its files, by name, hold its rows in the curve's order.

    A shard is cut by slot into as many tasks as its size asks for.
    """
    laid = sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    laid.write.partitionBy("shard").parquet(path)


def manifest(sharded: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """Smallest and largest value of each dimension in each shard."""
    ends = [f(d).alias(f"{at}_{d}") for d in dimensions for at, f in (("min", F.min), ("max", F.max))]
    return sharded.groupBy("shard").agg(*ends, F.count("*").alias("n_rows"))


def candidates(shard_manifest: DataFrame, **ranges: tuple) -> DataFrame:
    """Shards that may hold rows whose dimensions lie in the given closed ranges."""
    for dimension, (low, high) in ranges.items():
        shard_manifest = shard_manifest.where((F.col(f"max_{dimension}") >= low) & (F.col(f"min_{dimension}") <= high))
    return shard_manifest.select("shard")


def op1_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 runs of the curve over language, source, size and doc_id."""
    sized = with_size(table(spark, sf_dir, "documents"))
    sized = stage(sized.select("doc_id", "lang", "source", "size", "text_crc32"), "sizes").df
    placed = sized.withColumn("curve", curve_column(sized, DIMENSIONS, BITS))
    return cut_runs(placed, SHARDS).select("doc_id", *(c for c in ADDED if c != "curve"), "curve")
