"""Personal data: overlapping proposals, judged by gradient-boosted trees.

Generators propose spans. Those of the base forms that pass their check (parts of an address,
check digit, number of digits) are always kept. The looser ones (written-out e-mail signs,
numbers without a plus in any grouping, dotted cards, long addresses, shortened ones too) are
kept if boosted trees that see their format and context score them above a threshold. The trees
learn from the corpus itself: base forms that pass are examples; base forms that fail, other
numbers, an @ without an address, and looser forms behind a word that names something else
("version", "key") are counterexamples. The thresholds are calibrated on examples that the trees
have not seen, a kind each.

Training takes at most about MAX_EXAMPLES examples, as many of every kind and label, chosen by
a hash of where they stand. Calibration takes all that are held out, as histograms of scores.
One rule serves kinds of any number of examples: the precision that a kind shows is weighed
against what all kinds show, and that against the score, as if each had been seen PRIOR times.

Defined cases: a null text is empty; a table without both sorts of examples adds nothing to the
base spans, nor does a kind whose precision never reaches the wanted one; additions may overlap
base spans but not lie inside of one; overlapping additions go by score, then place; very long
texts are read whole, in time that grows with their length; repeated rows have a row each; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import add_columns, table
from siltstone.sources.staging import stage

KINDS = ("email", "ip", "card", "phone")
MAX_EXAMPLES = 20_000
HELD_OUT = 4  # one example in so many
PRECISION = 0.99
PRIOR = 1.0  # weight of what is believed before a kind's held-out examples are counted
BINS = 1000  # of a histogram of scores

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match of these can't begin inside a run of digits, as it would have begun at the run's start.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NUMBER = re.compile(r"(?<![0-9])[0-9]++(?:[.,-][0-9]++)*+")
_GROUP = re.compile(r"[0-9]++")

# Two to six groups with any separators, or one; the number of digits is checked afterwards.
_LOOSE_PHONE = re.compile(
    r"(?<![0-9A-Za-z+])(?<![0-9][.,:/-])\(?[0-9]++\)?(?:[\x20./()-]{1,2}[0-9]{2,9}(?![0-9])\)?){0,5}(?![0-9A-Za-z:])"
)
_LOOSE_CARD = re.compile(
    r"(?<![0-9.])[0-9]{4}([\x20./-])(?:[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{6}\1[0-9]{5})(?![0-9])"
    r"|(?<![0-9])[0-9]{13,16}(?![0-9])"
)
# Eight groups of an address, or fewer with one gap.
_LOOSE_IP = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}|:)(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Za-z:])")
_AT = re.compile(r"\x20?[\[(]at[\])]\x20?|\x20?@\x20?|\x20at\x20", re.I)
_DOT = r"(?:\x20?[\[(]dot[\])]\x20?|\x20dot\x20|\x20\.\x20|\.)"
_AFTER_AT = re.compile(rf"[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)*{_DOT}[A-Za-z]{{2,}}+", re.I)
_LABEL = re.compile(r"[A-Za-z0-9-]*+")

# Words before a span that speak for each kind, and for none.
_CUES = (
    re.compile(r"mail|contact|write to", re.I),
    re.compile(r"\bip\b|host|server|address", re.I),
    re.compile(r"card|visa|credit|pay", re.I),
    re.compile(r"phone|tel\b|call|fax|mobile", re.I),
)
_COUNTER_CUE = re.compile(r"token|key|version|licen[cs]e|hash|page|\bid\b", re.I)
FEATURES = 19


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their @ so that long runs of letters are read once."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def _digits(text: str) -> str:
    return "".join(_GROUP.findall(text))


def _fits_byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def base_forms(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """Matches of the base forms: kind, start, end and whether the check passes."""
    for start, end in _emails(text):
        yield 0, start, end, True
    if not _DIGIT.search(text):
        return
    for m in _IP.finditer(text):
        yield 1, m.start(), m.end(), all(map(_fits_byte, m[0].split(".")))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        yield 2, m.start(), m.end(), 14 <= len(digits) <= 19 and luhn(digits)
    for m in _PHONE.finditer(text):
        yield 3, m.start(), m.end(), 10 <= len(_digits(m[0])) <= 15


def _start_of_local(text: str, free: int, at: int) -> int:
    while at > free and text[at - 1] in _LOCAL:
        at -= 1
    return at


def _loose_emails(text: str) -> Iterator[tuple[int, int]]:
    free, worded = 0, " dot " in text.lower()
    for m in _AT.finditer(text):
        if m[0].lower() == " at " and not worded:
            continue
        start = _start_of_local(text, free, m.start())
        after = _AFTER_AT.match(text, m.end()) if start < m.start() else None
        if after:
            yield start, after.end()
        free = m.end()


def _is_address(span: str) -> bool:
    """An address of eight groups, or of fewer with one gap, with a digit in it."""
    groups = span.split(":")
    gaps = span.count("::")
    if ":::" in span or gaps > 1 or (span[0] == ":") != (span[:2] == "::") or (span[-1] == ":") != (span[-2:] == "::"):
        return False
    shown = sum(map(bool, groups))
    return (shown == 8 if not gaps else 2 <= shown <= 7) and bool(_DIGIT.search(span))


def loose_forms(text: str) -> Iterator[tuple[int, int, int]]:
    """Spans that may be personal data, of all kinds; they may overlap."""
    for start, end in _loose_emails(text):
        yield 0, start, end
    if not _DIGIT.search(text):
        return
    if ":" in text:
        for m in _LOOSE_IP.finditer(text):
            if _is_address(m[0]):
                yield 1, m.start(), m.end()
    for m in _LOOSE_CARD.finditer(text):
        yield 2, m.start(), m.end()
    for m in _LOOSE_PHONE.finditer(text):
        digits = _digits(m[0]).removeprefix("00")
        if 10 <= len(digits) <= 15 and not _IP.fullmatch(m[0]):
            yield 3, m.start(), m.end()


def _bare_signs(text: str) -> Iterator[tuple[int, int]]:
    """Every @ with the name before it and the label behind it."""
    free, at = 0, text.find("@")
    while at >= 0:
        end = _LABEL.match(text, at + 1).end()
        yield _start_of_local(text, free, at), end
        free = at + 1
        at = text.find("@", free)


def _side(c: str) -> float:
    return 0.0 if not c else 1.0 if c.isspace() else 2.0 if c.isalpha() else 3.0 if c.isdigit() else 4.0


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    """Format of a span and what stands around it.

    The plus and the @ are left out: every example of the base forms has them, and the
    looser forms, which are to be judged by the rest, do not.
    """
    span, before = text[start:end].lstrip("+"), text[max(0, start - 24) : start]
    groups = [len(g) for g in _GROUP.findall(span)]
    digits = _digits(span)
    own = [0.0] * 4
    own[kind] = 1.0
    return own + [
        float(min(len(span), 200)),
        float(min(len(digits), 100)),
        float(min(sum(c.isalpha() for c in span[:200]), 100)),
        float(sum(c in " .-()/" for c in span[:200])),
        float(min(len(groups), 50)),
        float(min(max(groups, default=0), 50)),
        float(min(min(groups, default=0), 50)),
        float(span.count(".")),
        float(1 < len(digits) < 100 and luhn(digits)),
        float(all(map(_fits_byte, _GROUP.findall(span)))),
        _side(text[start - 1 : start]),
        _side(text[end : end + 1]),
        float(bool(_CUES[kind].search(before))),
        float(bool(_COUNTER_CUE.search(before))),
        float(len(set(digits))),
    ]


def joined(spans: list[tuple[int, int, int]]) -> str:
    """Spans (start, kind, end) as one text."""
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def parsed(spans: str) -> list[tuple[int, int, int]]:
    out = []
    for span in filter(None, spans.split(",")):
        kind, start, end = span.split(":")
        out.append((int(start), KINDS.index(kind), int(end)))
    return out


def proposals(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, int]]]:
    """Base spans (start, kind, end), and judged or open spans (kind, start, end, label).

    The label is 1 for an example, 0 for a counterexample and -1 for a span to be judged.
    """
    base, spans = [], []
    for kind, start, end, passes in base_forms(text):
        spans.append((kind, start, end, int(passes)))
        if passes:
            base.append((start, kind, end))
    inside = _Taken(base)
    for kind, start, end in loose_forms(text):
        if not inside.holds(start, end):
            before = text[max(0, start - 24) : start]
            other = _COUNTER_CUE.search(before) and not _CUES[kind].search(before)
            spans.append((kind, start, end, 0 if other else -1))
    taken = _Taken([(start, kind, end) for kind, start, end, label in spans if label])
    for start, end in _bare_signs(text):
        if not taken.meets(start, end):
            spans.append((0, start, end, 0))
    for m in _NUMBER.finditer(text):
        if not taken.meets(m.start(), m.end()):
            kind = 1 if m[0].count(".") > 1 else 2 if len(m[0]) > 11 else 3
            spans.append((kind, m.start(), m.end(), 0))
    return sorted(base), spans


class _Taken:
    """Which places of a text some spans cover; spans may overlap."""

    def __init__(self, spans: list[tuple[int, int, int]]) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, _, end in sorted(spans):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def holds(self, start: int, end: int) -> bool:
        i = int(np.searchsorted(self.ends, end))
        return i < len(self.starts) and self.starts[i] <= start

    def meets(self, start: int, end: int) -> bool:
        i = int(np.searchsorted(self.ends, start, side="right"))
        return i < len(self.starts) and self.starts[i] < end


def _proposed() -> Callable:
    def propose(texts):
        out = []
        for text in texts:
            base, spans = proposals(text)
            counts = [sum(s[1] == k for s in base) for k in range(len(KINDS))]
            values = [v for kind, start, end, _ in spans for v in features(text, kind, start, end)]
            columns = list(map(list, zip(*spans, strict=True))) or [[], [], [], []]
            out.append((*counts, joined(base), *columns, values))
        return list(zip(*out, strict=True)) if out else [()] * 10

    return propose


def _thresholds(shown: dict[int, list[tuple[int, int, int]]]) -> dict[int, float]:
    """For every kind the lowest score from which on its examples reach the wanted precision.

    shown: for each kind the bin of the score, examples and counterexamples in it.
    """
    right = np.zeros((len(KINDS), BINS + 1))
    wrong = np.zeros((len(KINDS), BINS + 1))
    for kind, own in shown.items():
        for at, examples, others in own:
            right[kind, at] += examples
            wrong[kind, at] += others

    def beyond(counts: np.ndarray) -> np.ndarray:
        return counts[..., ::-1].cumsum(axis=-1)[..., ::-1]

    right, every = beyond(right), beyond(right + wrong)
    score = np.arange(BINS + 1) / BINS
    pooled = (right.sum(axis=0) + PRIOR * score) / (every.sum(axis=0) + PRIOR)
    precision = (right + PRIOR * pooled) / (every + PRIOR)
    reached = (precision >= PRECISION) & (score >= 0.5)
    return {kind: float(score[np.argmax(own)]) for kind, own in enumerate(reached) if own.any()}


def _scored(spans: DataFrame, model) -> DataFrame:
    vectors = spans.withColumn("features", array_to_vector("features"))
    return model.transform(vectors).withColumn("score", vector_to_array("probability")[1])


def found(docs: DataFrame) -> DataFrame:
    """For every document n_email, n_ip, n_card, n_phone, base_sha256 and spans."""
    counts = [f"n_{k}" for k in KINDS]
    arrays = {"_kind": "array<long>", "_start": "array<long>", "_end": "array<long>", "_label": "array<long>"}
    added = dict.fromkeys(counts, "long") | {"_base": "string"} | arrays | {"_values": "array<double>"}
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = add_columns(docs.select("doc_id", "text"), ["doc_id"], [text], _proposed, added)
    rows = stage(rows.withColumn("_uid", F.monotonically_increasing_id()), "proposals").df

    places = F.posexplode(F.arrays_zip(*arrays)).alias("_at", "_s")
    spans = rows.select("_uid", "_values", places)
    spans = spans.select(
        "_uid",
        *(F.col(f"_s.{c}").alias(c) for c in arrays),
        F.slice("_values", F.col("_at") * FEATURES + 1, F.lit(FEATURES)).alias("features"),
    )
    chosen = _additions(spans)
    if chosen is None:
        rows = rows.withColumn("_added", F.lit(None).cast("string"))
    else:
        texts = F.array_join(F.transform(F.sort_array(F.collect_list("_span")), lambda s: s["text"]), ",")
        rows = rows.join(chosen.groupBy("_uid").agg(texts.alias("_added")), "_uid", "left")

    def make() -> Callable:
        def merge(base, more):
            digests, every = [], []
            for own, extra in zip(base, more, strict=True):
                added: list[tuple[int, int, int]] = []
                for span in parsed(extra or ""):
                    at = bisect_left(added, span)
                    after = at < len(added) and added[at][0] < span[2]
                    if not after and not (at and added[at - 1][2] > span[0]):
                        added.insert(at, span)
                digests.append(hashlib.sha256(own.encode()).hexdigest())
                every.append(joined(parsed(own) + added))
            return digests, every

        return merge

    both, digests = [F.col("_base"), F.col("_added")], {"base_sha256": "string", "spans": "string"}
    return add_columns(rows, ["doc_id", *counts], both, make, digests)


def _additions(spans: DataFrame) -> DataFrame | None:
    """Open spans that score above their kind's threshold: _uid and _span (best first)."""
    examples = spans.where("_label >= 0")
    unit = F.pmod(F.xxhash64("_uid", "_kind", "_start"), F.lit(1 << 30))
    examples = examples.withColumn("_unit", unit).withColumn("label", F.col("_label").cast("double"))
    seen = F.pmod(F.xxhash64("_unit"), F.lit(HELD_OUT)) != 0
    # A row for each kind and label.
    sizes = examples.where(seen).groupBy("_kind", "_label").agg(F.count("*").alias("n")).collect()
    if len({r["_label"] for r in sizes}) < 2:
        return None
    chosen: Column = F.lit(False)
    for r in sizes:
        share = int((1 << 30) * min(1.0, MAX_EXAMPLES / (2 * len(KINDS)) / r["n"]))
        chosen |= (F.col("_kind") == r["_kind"]) & (F.col("_label") == r["_label"]) & (F.col("_unit") < share)
    training = stage(examples.where(seen & chosen).select("features", "label"), "examples").df
    if training.select("label").distinct().count() < 2:
        return None
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=12, maxDepth=3, stepSize=0.3, seed=7)
    # A bounded sample: a few partitions spare the trees' many short jobs their overhead.
    model = trees.fit(training.select(array_to_vector("features").alias("features"), "label").coalesce(2))
    at = F.floor(F.col("score") * BINS).cast("int").alias("_bin")
    unseen = _scored(examples.where(~seen), model).select("_kind", "_label", at)
    unseen = unseen.groupBy("_kind", "_bin").agg(
        F.count_if(F.col("_label") == 1).alias("right"), F.count_if(F.col("_label") == 0).alias("wrong")
    )
    shown: dict[int, list[tuple[int, int, int]]] = {kind: [] for kind in range(len(KINDS))}
    for r in unseen.collect():  # at most a row for each kind and bin
        shown[r["_kind"]].append((r["_bin"], r["right"], r["wrong"]))
    limits = _thresholds(shown)
    if not limits:
        return None
    passes: Column = F.lit(False)
    for kind, limit in limits.items():
        passes |= (F.col("_kind") == kind) & (F.col("score") >= limit)
    name = F.element_at(F.array(*map(F.lit, KINDS)), (F.col("_kind") + 1).cast("int"))
    text = F.concat_ws(":", name, F.col("_start").cast("string"), F.col("_end").cast("string"))
    best = F.struct((-F.col("score")).alias("rank"), "_start", "_end", text.alias("text"))
    return _scored(spans.where("_label = -1"), model).where(passes).select("_uid", best.alias("_span"))


def redact(text: str, spans: str) -> str:
    """The text with every span replaced by its kind in brackets."""
    out, at = [], 0
    for start, kind, end in parsed(spans):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def op2_boosted_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return found(table(spark, sf_dir, "documents"))
