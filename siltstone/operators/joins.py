"""Left outer joins: with hot keys spread over tasks, and onto a side of unique keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = "__salt"
SALTS = "__salts"
MATCHED = "__matched"

# Right rows of a key for each salt it gets.
ROWS_PER_SALT = 1_000_000


def left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: str,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """left LEFT JOIN right USING (key), with the fan-out of repeated right keys.

    Spark cannot cut the right side of a left join, so a key gets a salt for every
    rows_per_salt of its right rows, whatever their number: right rows are dealt out to the
    salts by a hash of their columns, left rows are repeated once for each salt. A repeat that
    meets no row of its salt is dropped, as the key has right rows under another salt.

    Keys of one salt need no entry in the table of salts, so it has at most one row for every
    rows_per_salt right rows, and that bound is what its broadcast rests on. A key that is
    hot on the left only is cut by Spark's own skew handling. Left rows with a NULL key match
    nothing; their salt is a hash of spread_by, so they do not all go to one task.
    """
    k = F.col(key)
    counts = right.where(k.isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__rows"))
    salts = F.ceil(F.col("__rows") / rows_per_salt).cast("int")
    hot = F.broadcast(counts.select(key, salts.alias(SALTS)).where(F.col(SALTS) > 1))

    repeated = left.join(hot, key, "left").withColumn(
        SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(SALTS), F.lit(1)) - 1))
    )
    repeated = repeated.withColumn(
        SALT, F.when(k.isNull(), F.xxhash64(F.col(spread_by))).otherwise(F.col(SALT).cast("long"))
    )
    # Text stands for a column of any type, also for those that have no hash of their own.
    image = F.xxhash64(*[F.col(c).cast("string") for c in right.columns])
    dealt = right.where(k.isNotNull()).join(hot, key, "left").withColumns(
        {
            SALT: F.coalesce(F.pmod(image, F.col(SALTS)), F.lit(0)).cast("long"),
            MATCHED: F.lit(True),
        }
    )
    joined = repeated.join(dealt.drop(SALTS), [key, SALT], "left")
    kept = F.col(SALTS).isNull() | F.coalesce(F.col(MATCHED), F.lit(False))
    return joined.where(kept).drop(SALT, SALTS, MATCHED)


def join_unique(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """left LEFT JOIN right USING (key), where right has each key once.

    Both sides meet by the key alone, so a right side that is grouped by it stays where it
    is. Left rows with a NULL key match nothing and are not moved.
    """
    added = {c: F.lit(None).cast(t) for c, t in right.dtypes if c != key}
    keyed = left.where(F.col(key).isNotNull()).join(right, key, "left")
    return keyed.unionByName(left.where(F.col(key).isNull()).withColumns(added))


def one_per_key(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """The key and columns of a side that must have each key once; a repeated key fails.

    The check is part of the grouping, so nothing runs before the query does, and the
    grouping leaves the side partitioned by the key for the join that follows.
    """
    counted = df.where(F.col(key).isNotNull()).groupBy(key)
    grouped = counted.agg(
        F.count(F.lit(1)).alias("__rows"), *[F.min(c).alias(c) for c in columns]
    )
    failure = F.raise_error(F.lit(f"{key} is repeated where each must be there once"))
    once = F.when(F.col("__rows") == 1, F.array(F.lit(0))).otherwise(failure.cast("array<int>"))
    # The check makes the rows, so that no plan can leave it out: Spark drops the join with a
    # side of distinct keys that no column is asked of.
    return grouped.select(key, *columns, F.explode(once).alias("__once")).drop("__once")
