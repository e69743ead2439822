"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame functions only.

Every source has a target number of words. The schedule has SLOTS places. Place i of the
base-2 van der Corput sequence is the point whose grid number is the bits of i in reverse;
mapped through the cumulative targets the point names a source. So the source between the
cumulative shares a / SLOTS and b / SLOTS owns the grid numbers from a to b - 1, spread
evenly over the schedule, and the rank of a place among its source's places is counted bit
by bit without sorting. The documents of a source, shuffled by a digest of their id, are cut
into blocks of equally many words; the place of rank r joins block r, and once all blocks
are used, the blocks again. The few places that rounding leaves a source short are added at
the end, and a source's last block is cut at its target. A document stands in the mix where its
first block of a pass is placed, which is the order that the mix is laid out in.

Defined cases: a null text has no words; a null source is one of its own, the last; a
source without words has target 0; a document of which nothing is taken has no place; very long
texts are counted whole and may lie in many blocks; repeated rows are rows of their own; equal
digests go by doc_id and size; an empty table gives an empty result. Other columns are kept by
`mix`, whatever their names, and ignored elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltstone.llm.common import put_back, set_apart, table, word_text
from siltstone.operators.ordering import in_order
from siltstone.sources.staging import stage

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
SLOT_BITS = 17
SLOTS = 1 << SLOT_BITS

WORD = r"[^\x20\x09-\x0D]+"


def source_key() -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n"))


def word_count() -> Column:
    return F.regexp_count(word_text("text"), F.lit(WORD)).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and digest of every document.

    _key is the source as a text that is never null.
    """
    return docs.select(
        "doc_id",
        "source",
        source_key().alias("_key"),
        word_count().alias("size"),
        F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("_digest"),
    )


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """One row for each source: its size and rows, target and quota in words.

    The excess over REPEATS times a source's size goes to the others by weight. Each round
    asks for two sums; it ends when no further source has reached its limit.
    """
    sources = rows.groupBy("_key", "source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows"))
    sources = in_order(sources, [F.col("source").asc_nulls_last()], "sources").drop("total")
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = sources.withColumn("_weight", weight.cast("long"))
    limit = F.col("source_size") * REPEATS
    total, rest = sources.agg(F.sum("source_size"), F.sum("_weight")).first()
    wanted = share * (total or 0)
    left, rest, closed = wanted, rest or 1, -1
    while True:
        capped = F.col("_weight") * F.lit(float(left)) / F.lit(float(rest)) >= limit
        found = sources.agg(
            F.count_if(capped), F.sum(F.when(capped, limit)), F.sum(F.when(~capped, F.col("_weight")))
        ).first()
        if found[0] == closed or not found[2]:
            break
        closed, left, rest = found[0], wanted - (found[1] or 0), found[2]
    target = F.when(capped, limit.cast("double")).otherwise(F.col("_weight") * F.lit(float(left)) / F.lit(float(rest)))
    return sources.withColumn("target", target).withColumn("_quota", F.floor("target")).drop("rank", "_weight")


def placed(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """The documents with _start, the words of their source before them in shuffled order.

    A source is split by digest into about the root of its row count of pieces, so that
    neither the pieces of a source nor the rows of a piece are many in one task.
    """
    unit = F.conv(F.substring("_digest", 1, 8), 16, 10).cast("double") / float(1 << 32)
    rows = rows.join(sources.drop("source"), "_key")
    rows = rows.withColumn("_piece", F.floor(unit * F.ceil(F.sqrt("_rows"))))
    pieces = rows.groupBy("_key", "_piece").agg(F.sum("size").alias("_words"))
    earlier = Window.partitionBy("_key").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_base", F.coalesce(F.sum("_words").over(earlier), F.lit(0))).drop("_words")
    inside = Window.partitionBy("_key", "_piece").orderBy("_digest", "doc_id", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_base") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    return rows.join(pieces, ["_key", "_piece"]).withColumn("_start", start).drop("_piece", "_base", "_digest", "_rows")


def _rank(number: str) -> str:
    """SQL for the places of a source before the one with this grid number.

    Another number comes earlier if it agrees on the low bits up to one that it lacks.
    """
    terms = []
    for bit in range(SLOT_BITS):
        half, full = 1 << bit, 2 << bit
        below = f"({number} % {half})"
        count = f"(_b - 1 - {below} + {full}) div {full} - (_a - 1 - {below} + {full}) div {full}"
        terms.append(f"if(({number} & {half}) = 0, 0, {count})")
    return " + ".join(terms)


def schedule(sources: DataFrame) -> DataFrame:
    """The places in use: place, source key, pass, block and the words from _from to _to of it."""
    ends = in_order(sources, [F.col("source").asc_nulls_last()], "shares", "_quota")
    grid = "cast((cast({} as decimal(38, 0)) * {} + whole - 1) div whole as bigint)"
    ends = ends.where("_quota > 0").withColumns(
        {
            "_block": F.expr(f"(whole + {SLOTS - 1}) div {SLOTS}"),
            "_a": F.expr(grid.format("before", SLOTS)),
            "_b": F.expr(grid.format("(before + _quota)", SLOTS)),
        }
    )
    blocks = "((source_size + _block - 1) div _block)"
    again = f"{blocks} + (_quota - source_size + _block - 1) div _block"
    needed = f"if(_quota <= source_size, (_quota + _block - 1) div _block, {again})"
    ends = ends.withColumns({"_blocks": F.expr(blocks), "_needed": F.expr(needed)})
    places = ends.withColumn("_j", F.explode(F.expr("sequence(0, greatest(_b - _a, _needed) - 1)")))
    reverse = f"cast(conv(reverse(lpad(bin(_number), {SLOT_BITS}, '0')), 2, 10) as bigint)"
    places = places.withColumn("_number", F.col("_a") + F.col("_j")).withColumns(
        {
            "place": F.expr(f"if(_j < _b - _a, {reverse}, {SLOTS} + _j)"),
            "rank": F.expr(f"if(_j < _b - _a, {_rank('_number')}, _j)"),
        }
    )
    places = places.where("rank < _needed").withColumns(
        {"pass": F.expr("if(rank < _blocks, 0, 1)"), "block": F.expr("rank % _blocks")}
    )
    end = "if(pass = 0, least(source_size, _quota), _quota - source_size)"
    return places.select(
        "place",
        "_key",
        "pass",
        "block",
        (F.col("block") * F.col("_block")).alias("_from"),
        F.expr(f"least((block + 1) * _block, {end})").alias("_to"),
        "_block",
    )


def mixed(docs: DataFrame) -> DataFrame:
    """Every document once a pass, with the words that the pass takes of it.

    Columns: doc_id, source, _key, size, source_size, target, _uid, pass, taken and place, the first
    place of the pass that holds words of it. A document without words has one row, with pass 0.
    """
    sizes = stage(sized(docs), "sizes")
    sources = stage(targets(sizes.df), "targets").df
    rows = placed(sizes.df, sources).withColumn("_uid", F.monotonically_increasing_id())
    rows = stage(rows, "placed", sizes.rows).df
    places = schedule(sources)
    block = sources.agg(F.expr(f"(sum(_quota) + {SLOTS - 1}) div {SLOTS}")).first()[0] or 1
    pieces = rows.where("size > 0").withColumn(
        "block", F.explode(F.expr(f"sequence(_start div {block}, (_start + size - 1) div {block})"))
    )
    # Spark takes the places for as few as the sources and would broadcast all of them, through the driver.
    met = pieces.join(places.drop("_block").hint("merge"), ["_key", "block"])
    words = F.expr("greatest(0, least(_start + size, _to) - greatest(_start, _from))")
    taken = met.withColumn("_words", words).groupBy("_uid", "pass").agg(
        F.sum("_words").alias("taken"), F.min(F.when(F.col("_words") > 0, F.col("place"))).alias("place")
    )
    kept = ["doc_id", "source", "_key", "size", "source_size", "target", "_uid"]
    return rows.select(*kept).join(taken, "_uid", "left").fillna(0, ["pass", "taken"])


def op4_source_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that the mix takes of every document, and its first place in the schedule."""
    rows = mixed(table(spark, sf_dir, "documents"))
    keys = ["_uid", "doc_id", "size", "source_size", "target"]
    return rows.groupBy(*keys).agg(F.sum("taken").alias("taken"), F.min("place").alias("first_place")).drop("_uid")


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself, in the order of the schedule: a document once for each pass that takes at least half of its words.

    Only the document at a pass's end is cut, so that words taken stay near the targets.
    Rows that agree in doc_id, source and size share their decision.
    """
    passes = mixed(docs).where("size > 0 AND taken * 2 >= size")
    copies = passes.groupBy("_uid", "doc_id", "_key", "size").agg(F.array_sort(F.collect_list("place")).alias("_places"))
    # Of equal rows the first one speaks for all; at most REPEATS places a document.
    copies = copies.groupBy("doc_id", "_key", "size").agg(F.max_by("_places", F.struct(F.size("_places"), F.negate(F.col("_uid")))).alias("_places"))
    copies = copies.select(*(F.col(c).alias(f"_m_{c}") for c in copies.columns))
    own, names = set_apart(docs, ["doc_id", "source", "text"])
    same = F.col("doc_id").eqNullSafe(F.col("_m_doc_id")) & (F.col("_own_key") == F.col("_m__key"))
    own = own.withColumns({"_own_key": source_key(), "_own_size": word_count()})
    found = own.join(copies, same & (F.col("_own_size") == F.col("_m_size")))
    found = found.withColumn("_place", F.explode("_m__places"))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = found.repartitionByRange(tasks, "_place", "doc_id").sortWithinPartitions("_place", "doc_id")
    return put_back(laid, names)


OP4_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sized GROUP BY source
), steps AS (
  SELECT *, 2 * source_size / CAST(weight AS DOUBLE) AS ratio,
         sum(2 * source_size) OVER w AS closed, sum(weight) OVER w AS closed_weight,
         sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
  FROM sources
  WINDOW w AS (ORDER BY 2 * source_size / CAST(weight AS DOUBLE) RANGE UNBOUNDED PRECEDING)
), level AS (
  SELECT max(ratio) FILTER (WHERE reached) AS ratio, coalesce(max(closed) FILTER (WHERE reached), 0) AS closed,
         coalesce(max(closed_weight) FILTER (WHERE reached), 0) AS closed_weight
  FROM (SELECT *, ratio * (weights - closed_weight) + closed <= 1.5 * total AS reached FROM steps)
), targets AS (
  SELECT s.source, s.source_size,
         CASE WHEN s.ratio <= l.ratio THEN CAST(2 * s.source_size AS DOUBLE)
              ELSE s.weight * CAST(1.5 * s.total - l.closed AS DOUBLE) / CAST(s.weights - l.closed_weight AS DOUBLE)
         END AS target
  FROM steps s, level l
), placed AS (
  SELECT d.source, d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS quota,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.digest, d.doc_id, d.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), shares AS (
  SELECT source, source_size, CAST(floor(target) AS BIGINT) AS quota,
         CAST(coalesce(sum(CAST(floor(target) AS BIGINT)) OVER (ORDER BY source NULLS LAST
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before,
         CAST(sum(CAST(floor(target) AS BIGINT)) OVER () AS BIGINT) AS whole
  FROM targets
), owners AS (
  SELECT *, (whole + 131071) // 131072 AS block_words, (before * 131072 + whole - 1) // whole AS a,
         ((before + quota) * 131072 + whole - 1) // whole AS b
  FROM shares WHERE quota > 0
), needs AS (
  SELECT *, (source_size + block_words - 1) // block_words AS blocks,
         CASE WHEN quota <= source_size THEN (quota + block_words - 1) // block_words
              ELSE (source_size + block_words - 1) // block_words + (quota - source_size + block_words - 1) // block_words
         END AS needed
  FROM owners
), points AS (
  SELECT i AS number, CAST(list_sum(list_transform(range(17), lambda k: ((i >> k) & 1) << (16 - k))) AS BIGINT) AS place
  FROM range(131072) AS t(i)
), places AS (
  SELECT source, source_size, quota, block_words, blocks, needed, place,
         row_number() OVER (PARTITION BY source ORDER BY place) - 1 AS rank
  FROM needs JOIN points ON number >= a AND number < b
  UNION ALL
  SELECT source, source_size, quota, block_words, blocks, needed, 131072 + j, j
  FROM (SELECT *, unnest(range(b - a, greatest(needed, b - a))) AS j FROM needs)
), used AS (
  SELECT source, place, block_words, rank % blocks AS block, (rank % blocks) * block_words AS low,
         least((rank % blocks + 1) * block_words,
               CASE WHEN rank < blocks THEN least(source_size, quota) ELSE quota - source_size END) AS high
  FROM places WHERE rank < needed
), firsts AS (
  SELECT p.source, p.doc_id, p.size, p.start, min(u.place) AS first_place
  FROM placed p JOIN used u ON p.source IS NOT DISTINCT FROM u.source
    AND u.block BETWEEN p.start // u.block_words AND (p.start + p.size - 1) // u.block_words
  WHERE p.size > 0 AND least(p.start + p.size, u.high) > greatest(p.start, u.low)
  GROUP BY 1, 2, 3, 4
)
SELECT p.doc_id, p.size, source_size, target,
       CAST(greatest(0, least(p.start + p.size, least(quota, source_size)) - p.start)
          + greatest(0, least(p.start + p.size, greatest(0, quota - source_size)) - p.start) AS BIGINT) AS taken,
       CAST(first_place AS BIGINT) AS first_place
FROM placed p LEFT JOIN firsts f ON p.source IS NOT DISTINCT FROM f.source AND p.doc_id IS NOT DISTINCT FROM f.doc_id
  AND p.size = f.size AND p.start = f.start
"""
