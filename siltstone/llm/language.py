"""Language identification by multilingual mixture inference.

Each language has a smoothed distribution over hashed letter trigrams, learned from labelled
documents. A document's trigrams are taken as drawn from a mixture of the languages, whose
proportions expectation-maximisation estimates. The set of languages is chosen by penalised
likelihood among the nested sets of the most frequent one, two, ... that reach MIN_PART: each
further language must pay for itself. Overlapping trigrams repeat letters, so a trigram
counts as a third of an observation there.

Training takes at most about MAX_DOCS documents a language, chosen by a hash of doc_id.

Defined cases: null texts and texts without a letter are "und" with score 0, as are all texts
if nothing was learned; equal proportions go to the first language by code point; rows
without doc_id are never held out; repeated rows have a row each; other columns than
doc_id, text and lang are ignored or, in `recognised`, kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import add_columns, put_back, ready_python, set_apart, table

UNKNOWN = "und"
BUCKETS = 4096
MAX_DOCS = 4000
SMOOTHING = 0.5
ROUNDS = 15
MIN_PART = 0.02
PENALTY = 2.0
MIN_SHARE = 0.3

_GROUP = 32  # documents that EM treats together
_LETTERS = 0x34000  # no letters are assigned beyond


def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(_LETTERS)), dtype=bool, count=_LETTERS)


def trigrams(text: str, letters: np.ndarray) -> np.ndarray | None:
    """Bucket of every letter trigram, words set apart by a space; None without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    known = letters[np.minimum(points, _LETTERS - 1)]
    if not known.any():
        return None
    x = np.where(known, points, np.uint32(32))
    x = x[known | np.concatenate(([True], known[:-1]))]
    x = np.concatenate(([np.uint32(32)], x, [np.uint32(32)]))
    h = x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA6B) + x[2:] * np.uint32(0xC2B2AE35)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(16)) & np.uint32(BUCKETS - 1)


def held_out() -> Column:
    crc = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8"))
    return crc % 4 == 2


def learn(docs: DataFrame, limit: int = MAX_DOCS) -> tuple[list[str], np.ndarray]:
    """The languages by code point and their trigram probabilities, a column each."""
    ready_python(docs.sparkSession)
    known = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return [], np.empty((BUCKETS, 0))
    unit = F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    few = [lang for lang, n in counts.items() if n <= limit]
    chosen = F.col("lang").isin(few)
    for lang, n in counts.items():
        if n > limit:
            chosen |= (F.col("lang") == lang) & (unit < limit / n)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, sums = _letters(), {}
        for batch in batches:
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                grams = trigrams(text, letters)
                if grams is not None:
                    sums.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                    sums[lang] += np.bincount(grams, minlength=BUCKETS)
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at), pa.array(n[at])], names=["lang", "bucket", "n"]
            )

    parts = known.where(chosen).select("lang", "text").mapInArrow(count, "lang string, bucket long, n long")
    rows = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()  # BUCKETS a language at most
    langs = sorted({r["lang"] for r in rows})
    table_ = np.full((BUCKETS, len(langs)), SMOOTHING)
    for r in rows:
        table_[r["bucket"], langs.index(r["lang"])] += r["n"]
    return langs, table_ / table_.sum(axis=0)


def proportions(counts: np.ndarray, model: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mixture proportions of each row of counts and the log-likelihood they reach."""
    parts = allowed / allowed.sum(axis=1, keepdims=True)
    total = counts.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        mixed = parts @ model.T
        parts = parts * ((counts / mixed) @ model) / total
    mixed = parts @ model.T
    return parts, (counts * np.log(mixed)).sum(axis=1)


def infer(counts: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Proportions of the languages of the set that penalised likelihood selects, for each row."""
    n, k = counts.shape[0], model.shape[1]
    full, _ = proportions(counts, model, np.ones((n, k), dtype=model.dtype))
    order = np.argsort(-full, axis=1, kind="stable")
    sizes = np.maximum(1, (full >= MIN_PART).sum(axis=1))
    best = np.zeros((n, k), dtype=model.dtype)
    best[np.arange(n), order[:, 0]] = 1
    several = np.flatnonzero(sizes > 1)
    if not len(several):
        return best
    log_n = np.log(counts[several].sum(axis=1))
    reached = (counts[several] * np.log(model.T[order[several, 0]])).sum(axis=1) / 3
    for size in range(2, int(sizes.max()) + 1):
        rows = np.flatnonzero(sizes[several] >= size)
        allowed = np.zeros((len(rows), k), dtype=model.dtype)
        np.put_along_axis(allowed, order[several[rows], :size], 1, axis=1)
        parts, likelihood = proportions(counts[several[rows]], model, allowed)
        value = likelihood / 3 - PENALTY * (size - 1) * log_n[rows]
        better = value > reached[rows]
        best[several[rows[better]]] = parts[better]
        reached[rows[better]] = value[better]
    return best


def _predictor(langs: list[str], model: np.ndarray) -> Callable[[], Callable]:
    def make():
        letters, probabilities = _letters(), model.astype(np.float32)

        def predict(texts: Sequence[str | None]):
            out: list[tuple[str, float, str | None]] = [(UNKNOWN, 0.0, None)] * len(texts)
            grams = [trigrams(t, letters) if t and langs else None for t in texts]
            at = [i for i, g in enumerate(grams) if g is not None]
            for start in range(0, len(at), _GROUP):
                own = at[start : start + _GROUP]
                counts = np.stack([np.bincount(grams[i], minlength=BUCKETS) for i in own]).astype(np.float32)
                for i, parts in zip(own, infer(counts, probabilities), strict=True):
                    top = int(np.argmax(parts))
                    mix = ",".join(f"{langs[j]}:{parts[j]:.3f}" for j in np.flatnonzero(parts))
                    out[i] = (langs[top], float(min(1.0, parts[top])), mix)
            return list(zip(*out, strict=True)) if out else ([], [], [])

        return predict

    return make


def predicted(docs: DataFrame, keep: Sequence[str], langs: list[str], model: np.ndarray) -> DataFrame:
    """The kept columns with lang_pred, score and languages (the selected set with its proportions)."""
    added = {"lang_pred": "string", "score": "double", "languages": "string"}
    return add_columns(docs, keep, [F.col("text")], _predictor(langs, model), added)


def recognised(docs: DataFrame) -> DataFrame:
    """The documents whose main language reaches MIN_SHARE, with their columns."""
    langs, model = learn(docs)
    own, names = set_apart(docs, ["text"])
    found = predicted(own, list(names.values()), langs, model)
    return put_back(found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_SHARE)), names)


def op3_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    langs, model = learn(docs)
    found = predicted(docs.withColumn("held_out", held_out()), ["doc_id", "held_out"], langs, model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "languages")
