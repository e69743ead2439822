"""Near-duplicate detection with order MinHash.

The k-mers of a document are its runs of SHINGLE words, labelled with their occurrence, so
that every labelled k-mer is there once. Each of ELEMENTS permutations picks the KEPT
smallest labelled k-mers and keeps them in text order; documents whose words agree in order
agree in many such elements. WIDE groups of 2 and NARROW groups of 4 elements are bucket
keys. Every text in a bucket is a candidate with the bucket's smallest and largest one, so
that a bucket of n texts gives 2 n - 3 candidates, all its pairs if n is 3 or less. Candidates
are verified by a banded alignment of the labelled k-mers: as each is there once, the longest
common subsequence within the band is a longest increasing one.

A larger bucket whose texts are all of one class by then is done. The texts of the others are
crowded, and searched by their rarest k-mers: of texts of n and m k-mers that share c or more,
the n - c + 1 rarest of one and the m - c + 1 rarest of the other have one in common, whatever
the order of rarity. Lengths go by classes two in a hundred wide, so that c is close to what a
pair needs and a template that many strangers share does not count among the rarest. Where up to
FEW texts share a rare k-mer, those of different classes are candidates.

More texts than that are measured against one of them, the hub, the one with most links. What
x and y share is at most what either shares with the hub, plus what they share outside of it. So
once x and the hub are compared, a text similar to x must have in common with it either nothing
but the hub's k-mers, which only texts as close to the hub as x can, or enough k-mers outside of
the hub; of these the rarest are the next keys. Texts around one hub are many, but what they
have outside of it is their own, so that few meet there; most are of the hub's class by then.
Every step only leaves out pairs that cannot be similar. So any two similar texts that share a
bucket end in one class.

Similarity is the share of aligned k-mers among all of both texts, the Jaccard index that
also asks for order; pairs of SIMILARITY or more are linked, and connected texts form a class.

Equal texts are one node from the start, and never form pairs. Two texts whose k-mers have a
Jaccard index of 0.8 in common share 8 of the 20 wide buckets on average, and none with a
chance of about 0.00003.

Defined cases: a null text counts as an empty one; texts without words are copies only of
equal texts; a text of fewer words than a k-mer has one k-mer, all its words; very long texts are
searched whole, their k-mers in pieces; of several texts with one doc_id each counts for itself,
all but one under an id made from the text; a row without doc_id gets such an id, too. Those
ids start at 2**62, so that rows with a doc_id lead their classes; repeated rows have a row each;
other columns are kept, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import add_columns, put_back, set_apart, table, word_text
from siltstone.llm.words import mixed, word_hashes
from siltstone.sources.staging import TEXT_ROWS, Staged, in_few, stage

SHINGLE = 5
SIMILARITY = 0.8
KEPT = 2
WIDE = 20
NARROW = 10
ELEMENTS = 2 * WIDE

RARITY = 1 << 21  # counters of k-mers; k-mers that share one only look less rare
FEW = 8  # texts that a rare k-mer may bring together pair by pair

_CHUNK = 1 << 14
_SEEDS = mixed(np.arange(1, ELEMENTS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = mixed(_SEEDS) | np.uint64(1)
_LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


def _length_classes() -> np.ndarray:
    """Where the classes of lengths begin."""
    starts = [0]
    while starts[-1] < 1 << 40:
        starts.append(starts[-1] + max(1, starts[-1] // 50))
    return np.array(starts)


_LENGTHS = _length_classes()


def kmers(text: str | None) -> np.ndarray:
    """The labelled k-mers of a text in order, each there once."""
    words = word_hashes(text)
    if not len(words):
        return words
    width = min(SHINGLE, len(words))
    n = len(words) - width + 1
    found = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        found = mixed(found + words[i : n + i] + np.uint64(i + 1))
    order = np.argsort(found, kind="stable")
    ranked = found[order]
    again = np.concatenate(([False], ranked[1:] == ranked[:-1]))
    if again.any():
        starts = np.flatnonzero(~again)
        label = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
        ranked = np.where(label > 0, mixed(ranked + label.astype(np.uint64) * _FACTORS[0]), ranked)
        found[order] = ranked
    return found


def _smallest(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every permutation the values and places of the two smallest of several k-mers."""
    values = (found ^ _SEEDS[:, None]) * _FACTORS[:, None]
    rows = np.arange(ELEMENTS)
    first = values.argmin(axis=1)
    low = values[rows, first]
    values[rows, first] = _LAST
    second = values.argmin(axis=1)
    return np.stack([low, values[rows, second]], axis=1), np.stack([first, second], axis=1)


def sketch(found: np.ndarray) -> np.ndarray:
    """The elements: for every permutation a hash of its two smallest k-mers in text order."""
    if len(found) == 1:
        return mixed(found[0] ^ _SEEDS)
    values, places = [], []
    for at in range(0, len(found), _CHUNK):
        part = found[at : at + _CHUNK]
        v, p = _smallest(part)
        if len(part) == 1:  # its second is the first again
            v, p = v[:, :1], p[:, :1]
        values.append(v)
        places.append(p + at)
    value, place = np.concatenate(values, axis=1), np.concatenate(places, axis=1)
    best = np.argsort(value, axis=1, kind="stable")[:, :KEPT]
    chosen = np.sort(np.take_along_axis(place, best, axis=1), axis=1)
    return mixed(mixed(found[chosen[:, 0]]) + found[chosen[:, 1]] + _SEEDS)


def bucket_keys(elements: np.ndarray) -> list[int]:
    keys = np.concatenate([_joined(elements.reshape(WIDE, 2), 0), _joined(elements.reshape(NARROW, 4), WIDE)])
    return keys.view(np.int64).tolist()


def _joined(groups: np.ndarray, first: int) -> np.ndarray:
    out = np.arange(first, first + len(groups), dtype=np.uint64)
    for column in groups.T:
        out = mixed(out + column)
    return out


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Aligned k-mers over all k-mers of two texts; 0 if that is below the least.

    At similarity s or more, at most (1 - s) / (1 + s) of the k-mers of both stand alone, and
    an aligned pair lies no further off the diagonal: that is the band.
    """
    if not len(a) or not len(b):
        return 0.0
    needed = least / (1 + least) * (len(a) + len(b)) - 1e-9
    if min(len(a), len(b)) < needed:
        return 0.0
    _, at_a, at_b = np.intersect1d(a, b, return_indices=True)
    inside = np.abs(at_a - at_b) <= len(a) + len(b) - 2 * needed
    at_a, at_b = at_a[inside], at_b[inside]
    if len(at_a) < needed:
        return 0.0
    places = at_b[np.argsort(at_a)]
    aligned = len(places)
    if (np.diff(places) < 0).any():
        ends: list[int] = []
        for place in places.tolist():
            i = bisect_left(ends, place)
            ends[i : i + 1] = [place]
        aligned = len(ends)
    return aligned / (len(a) + len(b) - aligned) if aligned >= needed else 0.0


def _text_keys() -> dict[str, Column]:
    """Two 64-bit hashes of the text, and the row's id."""
    text = word_text("text")
    one, two = F.xxhash64(text), F.xxhash64(F.lit("again"), text)
    return {"_k1": one, "_k2": two, "_id": F.coalesce(F.col("doc_id").cast("long"), _made_id(one, two))}


def _made_id(one: Column, two: Column) -> Column:
    """An id from 2**62 on for a text that has no doc_id to itself."""
    return F.lit(1 << 62) + F.pmod(F.xxhash64(one, two), F.lit(1 << 61))


def _nodes(rows: DataFrame) -> DataFrame:
    """_k1, _k2, _id and _node of every distinct text: its smallest id, and an id that is its alone."""
    texts = rows.groupBy("_k1", "_k2").agg(F.min("_id").alias("_id"))
    owners = texts.groupBy("_id").agg(F.min(F.struct("_k1", "_k2")).alias("_owner"))
    own = (F.col("_owner._k1") == F.col("_k1")) & (F.col("_owner._k2") == F.col("_k2"))
    node = F.when(own, F.col("_id")).otherwise(_made_id(F.col("_k1"), F.col("_k2")))
    return texts.join(owners, "_id").select("_k1", "_k2", "_id", node.alias("_node"))


def _bucketed(docs: DataFrame) -> DataFrame:
    def make() -> Callable:
        def keys(texts):
            found = map(kmers, texts)
            return ([bucket_keys(sketch(k)) if len(k) else [] for k in found],)

        return keys

    narrow = docs.select("doc_id", "text", *(c.alias(n) for n, c in _text_keys().items()))
    return add_columns(narrow, ["doc_id", "_id", "_k1", "_k2"], [F.col("text")], make, {"_keys": "array<long>"})


def _candidates(rows: DataFrame) -> DataFrame:
    """Pairs (_node, _hub): every text of a bucket with the smallest and the largest one of the bucket."""
    members = rows.where("_id = _least").select("_node", F.explode("_keys").alias("_key"))
    ends = members.groupBy("_key").agg(F.min("_node").alias("_low"), F.max("_node").alias("_high"))
    met = members.join(ends.where("_low < _high"), "_key")
    met = met.select("_node", F.explode(F.array("_low", "_high")).alias("_end")).where("_node <> _end")
    return met.select(F.greatest("_node", "_end").alias("_node"), F.least("_node", "_end").alias("_hub")).distinct()


def _kmers_of(docs: DataFrame, nodes: DataFrame, most: int) -> DataFrame:
    """_node and _kmers, the labelled k-mers of the texts of some nodes, so many at most, staged."""

    def make_kmers() -> Callable:
        return lambda texts: ([(kmers(t) >> np.uint64(32)).astype(np.uint32).tobytes() for t in texts],)

    texts = docs.select("text", *(c.alias(n) for n, c in _text_keys().items()))
    texts = texts.join(nodes, ["_id", "_k1", "_k2"])
    texts = add_columns(texts, ["_node"], [F.col("text")], make_kmers, {"_kmers": "binary"})
    return stage(texts.dropDuplicates(["_node"]), "kmers", most, TEXT_ROWS).df


def _aligned(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs whose alignment reaches the least similarity, with it."""

    def make_similarity() -> Callable:
        def compare(left, right):
            sides = ([np.frombuffer(k, np.uint32) for k in side] for side in (left, right))
            return ([similarity(a, b, least) for a, b in zip(*sides, strict=True)],)

        return compare

    one = texts.select("_node", F.col("_kmers").alias("_a"))
    two = texts.select(F.col("_node").alias("_hub"), F.col("_kmers").alias("_b"))
    both = pairs.join(one, "_node").join(two, "_hub")
    made = add_columns(both, ["_node", "_hub"], [F.col("_a"), F.col("_b")], make_similarity, {"similarity": "double"})
    return made.where(F.col("similarity") >= least)


def _crowded(rows: DataFrame, found: DataFrame) -> DataFrame:
    """_node and _class of the texts in buckets of more than three texts that are not of one class."""
    members = rows.where("_id = _least").select("_node", "_keys").join(found, "_node", "left")
    members = members.select("_node", F.coalesce("_class", "_node").alias("_class"), F.explode("_keys").alias("_key"))
    buckets = members.groupBy("_key").agg(
        F.count("*").alias("_n"), F.min("_class").alias("_low"), F.max("_class").alias("_high")
    )
    members = members.join(buckets.where("_n > 3 AND _low < _high").select("_key"), "_key")
    return members.select("_node", "_class").distinct()


def _by_rarity(found: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-mers from the rarest on, hashed, and whether another text may have them."""
    often = counts[found & np.uint32(len(counts) - 1)]
    order = np.lexsort((found, often))
    return mixed(found[order].astype(np.uint64)), often[order] > 1


def _lengths_of_partners(n: int, least: float) -> list[tuple[np.uint64, int]]:
    """For every class of lengths that a similar text may have: a tag of both classes, and the k-mers shared at least."""
    low, high = math.ceil(least * n - 1e-9), math.floor(n / least + 1e-9)
    own, first, last = (np.searchsorted(_LENGTHS, [n, low, high], side="right") - 1).tolist()
    out = []
    for other in range(first, last + 1):
        needed = math.ceil(least / (1 + least) * (n + max(low, int(_LENGTHS[other]))) - 1e-9)
        out.append((np.uint64(min(own, other) << 16 | max(own, other)), needed))
    return out


def rare_keys(found: np.ndarray, counts: np.ndarray, least: float) -> np.ndarray:
    """Keys that a text has in common with any text similar to it, for every class of lengths.

    counts holds how often the k-mers of a counter are there; k-mers that are there once give
    no key, as no other text has them.
    """
    n = len(found)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    ranked, shared = _by_rarity(np.unique(found), counts)
    out = []
    for tag, needed in _lengths_of_partners(n, least):
        size = max(0, n - needed + 1)
        out.append(mixed(ranked[:size][shared[:size]] + tag))
    return np.concatenate(out)


def keys_beside(found: np.ndarray, hub: np.ndarray, counts: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Keys that a text has in common with any text similar to it, given a hub for both, and how far each reaches.

    A similar text of m k-mers shares least / (1 + least) * (n + m) of them, of which at most as
    many as the text shares with the hub are the hub's. The rarest common one outside of the hub has
    the other common ones behind it, so a k-mer is a key for texts up to the length, its reach,
    at which enough are left. Where the hub's alone are enough, being that close to the hub is
    a key of its own. Two similar texts have a key whose reach, in both, is the other's length.
    """
    n = len(found)
    own = np.unique(found)
    beside = np.setdiff1d(own, hub)
    ranked, shared = _by_rarity(beside, counts)
    inside = n - len(beside)  # k-mers that share 32 bits count as the hub's
    left = np.concatenate([inside + len(beside) - np.arange(len(beside)), [inside]])
    reach = np.minimum(left * (1 + least) / least - n, n / least) + 1e-6
    keys = np.concatenate([ranked, np.zeros(1, dtype=np.uint64)])
    kept = np.concatenate([shared, [True]]) & (reach >= least * n - 1e-6)
    return keys[kept], np.floor(reach[kept]).astype(np.int64)


def _counts(texts: DataFrame) -> np.ndarray:
    """How often the k-mers of each counter are there."""

    def make_counters() -> Callable:
        def counters(found):
            slots = (np.unique(np.frombuffer(k, np.uint32)) & np.uint32(RARITY - 1) for k in found)
            return ([own.astype(np.int64).tolist() for own in slots],)

        return counters

    slots = add_columns(texts, [], [F.col("_kmers")], make_counters, {"_slots": "array<long>"})
    slots = slots.select(F.explode("_slots").alias("_slot")).groupBy("_slot").agg(F.count("*").alias("_n"))
    seen = slots.where("_n > 1").toArrow()  # at most a row for each counter
    counts = np.ones(RARITY, dtype=np.uint32)
    counts[seen["_slot"].to_numpy()] = np.minimum(seen["_n"].to_numpy(), 0xFFFFFFFF)
    return counts


def _pair() -> list[Column]:
    return [F.greatest("_node", "_end").alias("_node"), F.least("_node", "_end").alias("_hub")]


def _met(keyed: DataFrame, *key: str) -> DataFrame:
    """Pairs (_node, _hub) of different classes with a common key: those of a key's largest class meet all others.

    Rows with a _reach meet only those whose _size is within it, from either side.
    """
    sizes = keyed.groupBy(*key, "_class").agg(F.count("*").alias("_n"))
    kinds = sizes.groupBy(*key).agg(F.max_by("_class", "_n").alias("_main"), F.count("*").alias("_kinds"))
    keyed = keyed.join(kinds.where("_kinds > 1").drop("_kinds"), list(key))
    others = keyed.where("_class <> _main").drop("_main")
    named = {"_node": "_end", "_class": "_other", "_size": "_other_size", "_reach": "_other_reach"}
    others = others.select(*(F.col(c).alias(named.get(c, c)) for c in others.columns))
    met = keyed.join(others, list(key)).where("_class <> _other")
    if "_reach" in keyed.columns:
        met = met.where("_size <= _other_reach AND _other_size <= _reach")
    return met.select(*_pair()).distinct()


def _search_crowded(crowded: Staged, known: DataFrame, texts: DataFrame, least: float) -> Staged:
    """Links (_node, _hub, similarity) that join crowded texts of different classes.

    crowded: _node, _class and _links, the links found so far; known: pairs that are compared
    already. Links within a class are left out.
    """
    counts = _counts(texts)

    def make_keys() -> Callable:
        return lambda found: ([rare_keys(np.frombuffer(k, np.uint32), counts, least).view(np.int64).tolist() for k in found],)

    keyed = add_columns(texts, ["_node"], [F.col("_kmers")], make_keys, {"_keys": "array<long>"})
    keyed = keyed.join(crowded.df, "_node").select("_node", "_class", "_links", F.explode("_keys").alias("_key"))
    keyed, n_keys = stage(keyed, "rare", crowded.rows, TEXT_ROWS)
    sizes = keyed.groupBy("_key").agg(
        F.count("*").alias("_n"),
        F.min("_class").alias("_low"),
        F.max("_class").alias("_high"),
        F.max(F.struct("_links", "_node"))["_node"].alias("_hub"),
    )
    sizes = stage(sizes.where("_low < _high").select("_key", "_n", "_hub"), "sizes", n_keys).df
    few = sizes.where(F.col("_n") <= FEW).select("_key")
    pairs, n_pairs = stage(_met(keyed.drop("_links").join(few, "_key"), "_key"), "pairs", n_keys * (FEW - 1) // 2)
    links = _aligned(pairs.join(known, ["_node", "_hub"], "left_anti"), texts, least)
    links = stage(links, "links", n_pairs, TEXT_ROWS)

    spokes = keyed.join(sizes.where(F.col("_n") > FEW).select("_key", "_hub"), "_key")
    spokes, n_spokes = stage(spokes.where("_node <> _hub").select("_node", "_hub").distinct(), "spokes", n_keys)
    if not n_spokes:
        return links

    def make_spoke() -> Callable:
        def measure(left, right):
            sides = [[np.frombuffer(k, np.uint32) for k in side] for side in (left, right)]
            near = [similarity(a, b, least) for a, b in zip(*sides, strict=True)]
            found = [keys_beside(a, b, counts, least) for a, b in zip(*sides, strict=True)]
            keys, reach = ([own.view(np.int64).tolist() for own in column] for column in zip(*found, strict=True))
            return near, keys, reach, [len(a) for a in sides[0]]

        return measure

    one = texts.select("_node", F.col("_kmers").alias("_a"))
    two = texts.select(F.col("_node").alias("_hub"), F.col("_kmers").alias("_b"))
    both = spokes.join(one, "_node").join(two, "_hub")
    made = {"similarity": "double", "_keys": "array<long>", "_reach": "array<long>", "_size": "long"}
    measured = add_columns(both, ["_node", "_hub"], [F.col("_a"), F.col("_b")], make_spoke, made)
    measured = stage(measured, "spokes", n_spokes, TEXT_ROWS).df
    near = measured.where(F.col("similarity") >= least)
    near = near.select(F.col("_node"), F.col("_hub").alias("_end"), "similarity").select(*_pair(), "similarity")
    near = links.df.union(near)

    merged = _merged(crowded.df.select("_node", "_class"), near, links.rows + n_spokes)
    keys = F.explode(F.arrays_zip("_keys", "_reach")).alias("_at")
    beside = measured.join(merged, "_node").select(F.col("_hub").alias("_around"), "_node", "_class", "_size", keys)
    beside = beside.select("_around", "_node", "_class", "_size", F.col("_at._keys").alias("_key"), F.col("_at._reach").alias("_reach"))
    beside = stage(beside, "beside", n_spokes, TEXT_ROWS).df
    done = known.union(pairs).union(spokes.select(F.col("_node"), F.col("_hub").alias("_end")).select(*_pair()))
    pairs = _met(beside, "_around", "_key").join(done, ["_node", "_hub"], "left_anti")
    pairs, n_pairs = stage(pairs, "pairs")
    more = stage(_aligned(pairs, texts, least), "links", n_pairs, TEXT_ROWS)
    return stage(near.union(more.df).distinct(), "more", links.rows + n_spokes + more.rows)


def _merged(found: DataFrame, links: DataFrame, most: int) -> DataFrame:
    """_node and _class once links between the classes, so many at most, are counted in; found: _node and _class."""
    one = found.withColumnRenamed("_class", "_one")
    two = found.select(F.col("_node").alias("_hub"), F.col("_class").alias("_two"))
    between = links.join(one, "_node").join(two, "_hub").where("_one <> _two")
    between = between.select(F.greatest("_one", "_two").alias("_node"), F.least("_one", "_two").alias("_hub"))
    wider = components(in_few(between.distinct(), most))
    wider = wider.select(F.col("_node").alias("_class"), F.col("_class").alias("_wider"))
    return found.join(wider, "_class", "left").select("_node", F.coalesce("_wider", "_class").alias("_class"))


def components(links: DataFrame) -> DataFrame:
    """_node and _class, the smallest node it is connected with, for every node of the links.

    Every round takes the smallest label among the neighbours, then the label of the label, so
    that long chains need few rounds. Labels are staged after each round.
    """
    both = links.select(F.col("_node").alias("_from"), F.col("_hub").alias("_to"))
    both, n_ends = stage(both.union(both.select("_to", "_from")), "links")
    labels = both.groupBy(F.col("_from").alias("_node")).agg(F.min("_to").alias("_low"))
    labels = stage(labels.select("_node", F.least("_node", "_low").alias("_class")), "labels", n_ends).df
    while True:
        near = both.join(labels.withColumnRenamed("_node", "_to"), "_to")
        near = near.groupBy(F.col("_from").alias("_node")).agg(F.min("_class").alias("_near"))
        lower = labels.join(near, "_node").select(
            "_node", F.col("_class").alias("_was"), F.least("_class", "_near").alias("_class")
        )
        jump = lower.select(F.col("_node").alias("_class"), F.col("_class").alias("_jump"))
        lower = lower.join(jump, "_class").select("_node", "_was", F.least("_class", "_jump").alias("_class"))
        lower = stage(lower, "labels", n_ends).df
        labels = lower.select("_node", "_class")
        if lower.where("_was <> _class").isEmpty():
            return labels


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row for each row of docs: doc_id, _id, _k1, _k2, class_id and n_links.

    class_id is the smallest id of the class, n_links the number of candidates that the row's
    text was found similar to.
    """
    return _classified(docs, least)[0]


def _classified(docs: DataFrame, least: float) -> tuple[DataFrame, int]:
    """What `classes` returns, and the number of its rows."""
    rows, n_rows = stage(_bucketed(docs), "buckets")
    nodes, n_nodes = stage(_nodes(rows), "nodes", n_rows)
    rows = rows.join(nodes.withColumnRenamed("_id", "_least"), ["_k1", "_k2"])
    pairs, n_pairs = stage(_candidates(rows), "candidates", 2 * (WIDE + NARROW) * n_nodes)
    ends = pairs.select("_node").union(pairs.select("_hub")).distinct()
    texts = _kmers_of(docs, nodes.join(ends, "_node"), min(n_nodes, 2 * n_pairs))
    links, _ = stage(_aligned(pairs, texts, least), "links", n_pairs, TEXT_ROWS)
    found = components(links)
    crowded = _crowded(rows, found).join(_link_counts(links), "_node", "left")
    crowded = stage(crowded.select("_node", "_class", F.coalesce("_n", F.lit(0)).alias("_links")), "crowded", n_nodes)
    if crowded.rows:
        texts = _kmers_of(docs, nodes.join(crowded.df.select("_node"), "_node"), crowded.rows)
        more, n_more = _search_crowded(crowded, pairs, texts, least)
        every = found.select("_node", "_class").union(crowded.df.select("_node", "_class")).distinct()
        found = _merged(every, more, n_more)
        links = links.union(more).dropDuplicates(["_node", "_hub"])
    found = found.join(_link_counts(links), "_node", "left")
    out = rows.drop("_keys").join(found, "_node", "left")
    class_id = F.coalesce("_class", "_node").alias("class_id")
    return out.select("doc_id", "_id", "_k1", "_k2", class_id, F.coalesce("_n", F.lit(0)).alias("n_links")), n_rows


def _link_counts(links: DataFrame) -> DataFrame:
    """_node and _n, its links."""
    return links.select("_node").union(links.select("_hub")).groupBy("_node").agg(F.count("*").alias("_n"))


def one_of_each(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The documents without near copies: of every class the one with the smallest id stays."""
    found, n_rows = _classified(docs, least)
    kept = found.groupBy("class_id").agg(F.min(F.struct("_id", "_k1", "_k2")).alias("_k")).select("_k.*")
    kept = kept.select(F.col("_id").alias("_kept"), F.col("_k1").alias("_kept1"), F.col("_k2").alias("_kept2"))
    own, names = set_apart(docs, ["doc_id", "text"])
    own = own.withColumns(_text_keys())
    same = (F.col("_id") == F.col("_kept")) & (F.col("_k1") == F.col("_kept1")) & (F.col("_k2") == F.col("_kept2"))
    own = own.join(kept, same).dropDuplicates(["_id", "_k1", "_k2"])
    return put_back(in_few(own, n_rows, TEXT_ROWS), names)


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near copies of every document."""
    found = classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", "n_links")
