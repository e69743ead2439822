"""Conversations formatted by a compiled template, with the spans a model learns.

A conversation's rows come to one task sorted by turn and are rendered one after another, so
that a long conversation is never held as a whole. Control strings inside texts and roles
are escaped: a backslash goes after their first character, and backslashes are doubled.

Defined cases: a null text or role is empty; rows of one turn go by role, then text; turns
without number come last; a null conv_id is a conversation; repeated rows are turns of their
own; an empty table gives the fixed conversation only. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import BATCH_ROWS, ready_python, table
from siltstone.llm.templates import compile_template

CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "[/TURN]")
TEMPLATE = (
    "<s>{% for turn in turns %}"
    "{% if turn.role == 'user' %}[INST]{{ turn.text | escape }}[/INST]"
    "{% elif turn.role == 'assistant' %}{% generation %}{{ turn.text | escape }}{% endgeneration %}</s>"
    "{% else %}[ROLE]{{ turn.role | escape }}[/ROLE]{{ turn.text | escape }}[/TURN]"
    "{% endif %}{% endfor %}"
)
PROBE = -7
PROBE_TEXT = "</s>[INST] ok [/INST]"

_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_ESCAPED = re.compile(r"\\(\\?)")


def escape(text: str | None) -> str:
    """Text without any control string; `unescape` gives it back."""
    doubled = (text or "").replace("\\", "\\\\")
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], doubled)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def read_turns(formatted: str) -> tuple[list[tuple[str, str]], str]:
    """Roles and texts of the complete turns of a formatted text, and what is left behind them."""
    out, at = [], 0
    if formatted.startswith("<s>"):
        at = len("<s>")
    while at < len(formatted):
        start = at
        if formatted.startswith("[INST]", at):
            role, at, mark = "user", at + len("[INST]"), "[/INST]"
        elif formatted.startswith("[ROLE]", at):
            end = formatted.find("[/ROLE]", at)
            if end < 0:
                return out, formatted[start:]
            role = unescape(formatted[at + len("[ROLE]") : end])
            at, mark = end + len("[/ROLE]"), "[/TURN]"
        else:
            role, mark = "assistant", "</s>"
        end = formatted.find(mark, at)
        if end < 0:
            return out, formatted[start:]
        out.append((role, unescape(formatted[at:end])))
        at = end + len(mark)
    return out, ""


class _Reader:
    """Digests of one conversation, read back from the formatted pieces as they come."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0
        self.rest = ""
        self.learned = ""

    def __call__(self, piece: str, learned: bool) -> None:
        self.formatted_chars += len(piece)
        self.rest += piece
        if learned:
            self.learned += piece

    def turn_ended(self) -> None:
        found, self.rest = read_turns(self.rest)
        for role, text in found:
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        text, self.learned = unescape(self.learned), ""
        self.loss_chars += len(text)
        self.loss.update(text.encode("utf-8", "surrogatepass"))

    def row(self) -> tuple:
        if self.rest not in ("", "<s>"):
            raise ValueError("a formatted conversation could not be read back")
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars


def sorted_turns(rows: DataFrame) -> DataFrame:
    """conv_id, role and text, a conversation's rows together and in order."""
    own = rows.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = own.repartition(tasks, "conv_id")
    return dealt.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "role", "text").drop("turn")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _turns(rows: Iterator[tuple], ended: Callable[[], None]) -> Iterator[dict]:
    """Turns one at a time; ended is told when the template asks for the next or finds none."""
    for _, role, text in rows:
        yield {"role": role, "text": text}
        ended()


def formatted(rows: DataFrame, source: str = TEMPLATE) -> DataFrame:
    """Pieces of the formatted conversations: conv_id, piece (0, 1, ...), text, learned, start.

    The pieces of one conversation are held until it ends; `read_back` holds one turn.
    """
    ready_python(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = compile_template(source, escape=escape)
        for conv_id, own in groupby(_rows(batches), key=lambda r: r[0]):
            pieces: list[tuple[str, bool]] = []

            def receive(text: str, learned: bool, pieces=pieces) -> None:
                if text:
                    pieces.append((text, learned))

            template({"turns": _turns(own, lambda: None)}, receive)
            at = 0
            for first in range(0, len(pieces), BATCH_ROWS):
                texts, learned = zip(*pieces[first : first + BATCH_ROWS], strict=True)
                starts = [at]
                for text in texts:
                    starts.append(starts[-1] + len(text))
                at = starts.pop()
                n = len(texts)
                columns = [
                    pa.array([conv_id] * n, pa.int64()),
                    pa.array(range(first, first + n), pa.int64()),
                    pa.array(texts, pa.string()),
                    pa.array(learned, pa.bool_()),
                    pa.array(starts, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["conv_id", "piece", "text", "learned", "start"]
                )

    schema = "conv_id long, piece long, text string, learned boolean, start long"
    return sorted_turns(rows).mapInArrow(run, schema)


_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
_RESULT = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(zip(*rows, strict=True), _TYPES, strict=True)
    names = [c.split()[0] for c in _RESULT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=names)


def read_back(rows: DataFrame, source: str = TEMPLATE) -> DataFrame:
    """Every conversation formatted, and what its formatted text says when it is read back."""
    ready_python(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = compile_template(source, escape=escape)
        out: list[tuple] = []
        for conv_id, own in groupby(_rows(batches), key=lambda r: r[0]):
            reader = _Reader()
            template({"turns": _turns(own, reader.turn_ended)}, reader)
            out.append((conv_id, *reader.row()))
            if len(out) == BATCH_ROWS:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    return sorted_turns(rows).mapInArrow(run, _RESULT)


def op8_template_compiler(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = [(PROBE, 0, "user", PROBE_TEXT), (PROBE, 1, "assistant", PROBE_TEXT)]
    return read_back(rows.union(spark.createDataFrame(probe, rows.schema)))


def _escaped_length(column: str) -> str:
    """SQL for the length of an escaped text: a character more for each backslash and control string."""
    controls = "|".join(map(re.escape, CONTROL))
    doubled = f"replace({column}, chr(92), chr(92) || chr(92))"
    return f"length(regexp_replace({doubled}, '({controls})', '\\1-', 'g'))"


_ORDER = "ORDER BY turn NULLS LAST, role, text"
OP8_SQL = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT * FROM (VALUES ({PROBE}, 0, 'user', '{PROBE_TEXT}'), ({PROBE}, 1, 'assistant', '{PROBE_TEXT}')) AS p(conv_id, turn, role, text))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' {_ORDER})) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' {_ORDER}) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST({len("<s>")} + sum(CASE role
           WHEN 'user' THEN {len("[INST][/INST]")} + {_escaped_length("text")}
           WHEN 'assistant' THEN {len("</s>")} + {_escaped_length("text")}
           ELSE {len("[ROLE][/ROLE][/TURN]")} + {_escaped_length("role")} + {_escaped_length("text")} END) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""
