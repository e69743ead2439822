"""Benchmark decontamination with an Aho-Corasick automaton.

A window is WINDOW consecutive words of a benchmark text, or the whole of a shorter one. The
texts are cut into blocks of half a window, one after another, so that every window holds a
whole block. The blocks are the automaton's patterns, each with the words on both sides of it
in its texts, as many as a window around the block can have. Every document is brought to the
same normal form and scanned once; where a block is found and enough words beside it agree,
windows are found. Ends of matches are mapped to words, and these to places in the original
text. Blocks take a tenth of the automaton that the windows themselves would.

Blocks with their neighbours beyond MAX_BYTES are split by hash into several automata, each
of which the documents pass in turn, so that what is sent to the executors stays bounded
while every window is searched. A worker builds an automaton once, not once a task.

Defined cases: null and empty texts have no words, hits or windows; an item without words
has no window; items of the same id count once; an item without id counts under the empty
text; repeated documents have a row each; an empty benchmark hits nothing. Other columns of
the documents are kept if asked for.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import add_columns, put_back, set_apart, table
from siltstone.llm.words import WORD, normal, words
from siltstone.sources.staging import stage

WINDOW = 10
MAX_BYTES = 16_000_000

_BETWEEN = "\x1f"


def blocks(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """Every different block with its neighbours, in normal form, and the sorted ids of its items.

    lead is the number of neighbours before the block, size the number of its words.
    """
    half = (width + 1) // 2
    beside = width - half

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = words(text)
                if len(found) >= width:
                    at = range(0, len(found) - half + 1, half)
                    parts = [(found[max(0, i - beside) : i + half + beside], min(i, beside), half) for i in at]
                else:
                    parts = [(found, 0, len(found))] if found else []
                own = {(b" ".join(part), lead, size) for part, lead, size in parts}
                patterns, leads, sizes = zip(*own, strict=True) if own else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([item] * len(own), pa.string()),
                        pa.array(patterns, pa.binary()),
                        pa.array(leads, pa.int32()),
                        pa.array(sizes, pa.int32()),
                    ],
                    names=["item_id", "pattern", "lead", "size"],
                )

    ids = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    cuts = items.select(ids.alias("item_id"), F.col("text").cast("string")).mapInArrow(
        cut, "item_id string, pattern binary, lead int, size int"
    )
    named = F.sort_array(F.collect_set("item_id")).alias("items")
    return cuts.groupBy("pattern", "lead", "size").agg(named)


def _ids(joined: str | None) -> list[str]:
    return joined.split(_BETWEEN) if joined is not None else []


class _Neighbours(NamedTuple):
    before: tuple[bytes, ...]  # the nearest first
    after: tuple[bytes, ...]
    items: tuple[str, ...]


class _Block:
    """A pattern: the items that it is the whole of, and its neighbours by the word beside it.

    A window around a block has the word after the block, or else all words that can stand
    before it. So neighbours are looked up by either.
    """

    def __init__(self, size: int) -> None:
        self.size = size
        self.whole: tuple[str, ...] = ()
        self.by_next: dict[bytes, list[_Neighbours]] = {}
        self.by_last: dict[tuple[bytes, ...], list[_Neighbours]] = {}

    def add(self, own: _Neighbours, beside: int) -> None:
        if own.after:
            self.by_next.setdefault(own.after[0], []).append(own)
        if len(own.before) == beside:
            self.by_last.setdefault(own.before, []).append(own)


Patterns = list[tuple[bytes, int, int, tuple[str, ...]]]


def _agree(found: list[bytes], at: int, step: int, wanted: tuple[bytes, ...]) -> int:
    """How many of the wanted words stand in the text from a place on, forwards or backwards."""
    n = 0
    for word in wanted:
        if not 0 <= at < len(found) or found[at] != word:
            break
        n, at = n + 1, at + step
    return n


class _Finder:
    """Finds the windows of a text by the automaton of blocks."""

    def __init__(self, patterns: Patterns, width: int) -> None:
        self.width, self.beside = width, width - (width + 1) // 2
        own: dict[str, _Block] = {}
        known: dict[bytes, bytes] = {}  # one object a word
        for pattern, lead, size, items in patterns:
            part = [known.setdefault(w, w) for w in pattern.split(b" ")]
            end = lead + size
            block = own.setdefault(normal(part[lead:end]), _Block(size))
            if size == len(part):
                block.whole += items
            else:
                block.add(_Neighbours(tuple(part[:lead][::-1]), tuple(part[end:]), items), self.beside)
        self.automaton = ahocorasick.Automaton()
        for pattern, block in own.items():
            self.automaton.add_word(pattern, block)
        if own:
            self.automaton.make_automaton()
        self.empty = not own

    def __call__(self, text: str | None) -> tuple[list[int], set[str]]:
        """Word ranges [from, to, ...] of the windows and the ids of their items."""
        found = words(text) if not self.empty else []
        ranges: list[int] = []
        items: set[str] = set()
        if not found:
            return ranges, items
        joined, ends = normal(found), None
        for end, block in self.automaton.iter(joined):
            if ends is None:
                ends = np.flatnonzero(np.frombuffer(joined.encode("latin-1"), np.uint8) == 32)
            stop = int(np.searchsorted(ends, end))
            start = stop - block.size
            if block.whole:
                ranges += (start, stop)
                items.update(block.whole)
            near = block.by_next.get(found[stop], ()) if stop < len(found) else ()
            if block.by_last and start >= self.beside:
                near = [*near, *block.by_last.get(tuple(found[start - self.beside : start][::-1]), ())]
            for own in near:
                left = _agree(found, start - 1, -1, own.before)
                right = _agree(found, stop, 1, own.after)
                if left + block.size + right >= self.width:
                    ranges += (start - left, stop + right)
                    items.update(own.items)
        return ranges, items


_built: dict[str, _Finder] = {}


def _finder(name: str, shared: Broadcast[Patterns], width: int) -> _Finder:
    """The finder of a scan; a worker process keeps the last one for its next task."""
    if name not in _built:
        _built.clear()
        _built[name] = _Finder(shared.value, width)
    return _built[name]


def scan(docs: DataFrame, keep: Sequence[str], patterns: Patterns, width: int, first: bool) -> DataFrame:
    """docs with _hits, word ranges [from, to, ...], and _items, the ids of items found.

    Later scans add to what earlier ones found.
    """
    shared, name = docs.sparkSession.sparkContext.broadcast(patterns), uuid.uuid4().hex

    def make():
        search = _finder(name, shared, width)

        def find(texts, hits, items):
            out_hits, out_items = [], []
            for text, before, ids in zip(texts, hits, items, strict=True):
                ranges, own = search(text)
                own.update(_ids(ids))
                out_hits.append([*(before or ()), *ranges])
                out_items.append(_BETWEEN.join(sorted(own)) if own else None)
            return out_hits, out_items

        return find

    before = [F.col("_hits"), F.col("_items")]
    if first:
        before = [F.lit(None).cast("array<long>"), F.lit(None).cast("string")]
    added = {"_hits": "array<long>", "_items": "string"}
    return add_columns(docs, keep, [F.col("text"), *before], make, added)


def _merged(ranges: list[int]) -> list[tuple[int, int]]:
    """Disjoint word ranges in order."""
    out: list[list[int]] = []
    for start, end in sorted(zip(ranges[::2], ranges[1::2], strict=True)):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def searched(
    docs: DataFrame,
    items: DataFrame,
    keep: Sequence[str],
    width: int = WINDOW,
    limit: int = MAX_BYTES,
) -> DataFrame:
    """The kept columns, text, _hits and _items of every document."""
    # A block is half a window of words, or the whole of a short item.
    n, chars = items.agg(F.count("*"), F.sum(F.length(F.col("text").cast("string")))).first()
    found = stage(blocks(items, width), "blocks", n + (chars or 0) // (width + width % 2)).df
    n = found.agg(F.sum(F.octet_length("pattern"))).first()[0] or 0
    groups = max(1, -(-n // limit))
    kept = list(dict.fromkeys([*keep, "text"]))
    docs = docs.select(*kept)
    for group in range(groups):
        # A block and its neighbours go together or apart: each row finds its own windows.
        part = found.where(F.pmod(F.xxhash64("pattern"), F.lit(groups)) == group)
        rows = part.collect()  # about limit bytes, as the hash shares them out
        patterns = [(bytes(r["pattern"]), r["lead"], r["size"], tuple(r["items"])) for r in rows]
        if group:  # else one task would hold the automata of all scans
            docs = stage(docs, "scanned").df
        docs = scan(docs, kept, patterns, width, first=group == 0)
    return docs


def _digest():
    def rows(texts, hits, items):
        out = []
        for text, ranges, ids in zip(texts, hits, items, strict=True):
            merged = _merged(ranges or [])
            own = _ids(ids)
            spans = ""
            if merged:
                places = [m.span() for m in WORD.finditer(text)]
                spans = ",".join(f"{places[a][0]}:{places[b - 1][1]}" for a, b in merged)
            n_hit = sum(b - a for a, b in merged)
            sha = hashlib.sha256(",".join(own).encode()).hexdigest()
            out.append((len(words(text)), n_hit, len(own), sha, n_hit > 0, spans))
        return list(zip(*out, strict=True)) if out else [()] * 6

    return rows


def contamination(docs: DataFrame, items: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """For every document: n_words, n_hit, n_items, items_sha256, contaminated and hit_spans.

    hit_spans has the code points start:end of every run of hit words in the original text.
    """
    added = dict.fromkeys(["n_words", "n_hit", "n_items"], "long")
    added |= {"items_sha256": "string", "contaminated": "boolean", "hit_spans": "string"}
    found = searched(docs, items, keep)
    columns = [F.coalesce(F.col("text"), F.lit("")), F.col("_hits"), F.col("_items")]
    return add_columns(found, list(keep), columns, _digest, added)


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without any benchmark window, with their columns."""
    own, names = set_apart(docs, ["text"])
    return put_back(searched(own, items, own.columns).where(F.size("_hits") == 0), names)


def op10_benchmark_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("hit_spans")


OP10_SQL = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS pattern, least(len(w), 10) AS width
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM item_words WHERE len(w) > 0)
), widths AS (SELECT DISTINCT width FROM item_windows),
doc_words AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), doc_windows AS (
  SELECT row_id, i, width, array_to_string(w[i:i + width - 1], ' ') AS pattern
  FROM (SELECT row_id, w, width, unnest(range(1, len(w) - width + 2)) AS i
        FROM doc_words, widths WHERE len(w) >= width)
), found AS (
  SELECT DISTINCT d.row_id, d.i, d.width, b.item_id
  FROM doc_windows d JOIN item_windows b ON d.pattern = b.pattern AND d.width = b.width
), hits AS (
  SELECT row_id, count(DISTINCT i + k) AS n_hit
  FROM (SELECT row_id, i, unnest(range(0, width)) AS k FROM found) GROUP BY row_id
), items AS (
  SELECT row_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT row_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY row_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(t.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(t.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hits h ON d.row_id = h.row_id LEFT JOIN items t ON d.row_id = t.row_id
"""
