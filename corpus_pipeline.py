"""A training corpus from documents: five stages, each on all rows that the one before kept.

language         documents in a language that was recognised stay
near_duplicates  one document of each class of near copies stays
decontamination  documents that hold a benchmark window go
mixing           documents as often as the mix of sources takes them
sharding         the mix along the Hilbert curve, in runs, with shard and slot

Each stage takes (spark, docs, sf_dir). All but the last return the columns of documents; the
last adds size, text_crc32, curve, law, shard, slot and grown_shard. Nulls, empty texts,
repeated rows and empty tables are treated as in the stages' operators: texts without a letter
go at the first stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm import decontamination, language, mixing, neardup, sharding
from siltstone.llm.common import table
from siltstone.sources.staging import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def recognise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.recognised(docs)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shards(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", recognise),
    ("near_duplicates", deduplicate),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

#: SQL can express neither the language models nor the sketches.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on documents; each one's rows are written before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name).df
    return docs
