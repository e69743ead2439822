import hashlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import chat as C
from siltstone.llm import templates as T
from siltstone.llm.common import table
from tests.conftest import SMALL


def show(source, **names):
    return T.render(T.compile_template(source), **names)[0]


def test_template_language():
    assert show("a{{ 1 + 2 }}{{ 'x' + \"y\" }}{{ none }}b") == "a3xyb"
    assert show("{% for t in ts %}{% if t.a == 1 %}one{% elif t.a > 1 and not t.b %}more{% else %}-{% endif %},{% endfor %}", ts=[{"a": 1}, {"a": 2}, {"a": 3, "b": 1}, {"a": 0}]) == "one,more,-,-,"
    assert show("{% set n = name | trim | upper %}{{ n }}{{ n | length }}", name=" ab ") == "AB2"
    assert show("{{ missing.field }}{{ 'a\\n\\'' }}{{ (true or false) and 'z' }}") == "a\n'z"
    assert show("{% for t in missing %}x{% endfor %}{% if none %}y{% endif %}") == ""


@pytest.mark.parametrize("source", ["{{ }}", "{{ a( }}", "{{ a.b.c", "{% if a %}", "{% for x %}{% endfor %}", "{% nope %}", "{{ a | nope }}", "{{ 'a' + 1 }}", "{% set 1 = 2 %}", "{{ a b }}", "{{ a[0] }}"])
def test_bad_templates_are_refused(source):
    if source == "{{ a.b.c":
        assert show(source) == source  # an unclosed tag is text
        return
    with pytest.raises(T.TemplateError):
        T.compile_template(source)


def test_templates_reach_no_python_objects():
    with pytest.raises(T.TemplateError):
        show("{{ t.__class__ }}", t="text")
    assert show("{{ t.__class__ }}", t={}) == ""


def test_constants_are_folded():
    folded = T.fold(T.parse("a{% if 1 + 1 == 2 %}b{{ 'c' | upper }}{% else %}{{ x }}{% endif %}d", T.FILTERS), T.FILTERS)
    assert folded == ("block", [("text", "abCd")])
    assert T.fold(T.parse("{% if false %}x{% endif %}", T.FILTERS), T.FILTERS) == ("block", [])
    assert T.fold(T.parse("{{ true and x }}", T.FILTERS), T.FILTERS) == ("block", [("print", ("name", "x"))])


def test_generation_marks_and_streams():
    template = T.compile_template("<{% for t in turns %}{% generation %}{{ t }}{% endgeneration %};{% endfor %}>")
    text, spans = T.render(template, turns=["ab", "", "c"])
    assert text == "<ab;;c;>" and [text[a:b] for a, b in spans] == ["ab", "c"]
    seen = []
    T.stream(template, (seen.append(("read", t)) or t for t in "xy"), lambda t, g: seen.append((t, g)))
    assert seen.index(("x", True)) < seen.index(("read", "y"))


parts = st.sampled_from([*C.CONTROL, "\\", "\\\\", "a", "[", "<", "/", "INST]", "s>", "\n", "é"])


@given(st.lists(parts, max_size=12).map("".join))
@settings(max_examples=500, deadline=None)
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    escaped = C.escape(text)
    assert C.unescape(escaped) == text
    assert not any(c in escaped for c in C.CONTROL)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "[/ROLE]", ""]), st.lists(parts, max_size=5).map("".join)), max_size=6))
@settings(max_examples=300, deadline=None)
def test_formatted_conversations_read_back(turns):
    template = T.compile_template(C.TEMPLATE, escape=C.escape)
    text, spans = T.render(template, turns=[{"role": r, "text": t} for r, t in turns])
    assert C.read_turns(text) == (turns, "")
    assert [C.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant" and t]


def _brute(rows):
    groups = {}
    for conv, turn, role, text in rows:
        groups.setdefault(conv, []).append((turn is None, turn or 0, role or "", text or ""))
    out = {}
    for conv, own in groups.items():
        own.sort()
        turns = "".join(f"{r}\n{t}\n" for _, _, r, t in own)
        loss = "".join(t for _, _, r, t in own if r == "assistant")
        out[conv] = (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def _check(spark, where):
    rows = [tuple(r) for r in table(spark, where, "conversations").select("conv_id", "turn", "role", "text").collect()]
    rows += [(C.PROBE, 0, "user", C.PROBE_TEXT), (C.PROBE, 1, "assistant", C.PROBE_TEXT)]
    got = {r[0]: tuple(r)[1:5] for r in C.op8_template_compiler(spark, where).collect()}
    assert got == _brute(rows)


def test_all_conversations(spark, odd_dir, empty_dir):
    for where in (SMALL, odd_dir, empty_dir):
        _check(spark, where)


@pytest.mark.parametrize("where", ["odd", "/root/testdata/sf0.01"])
def test_sql_gives_the_same_rows(spark, odd_dir, where):
    path = odd_dir if where == "odd" else where
    spark_rows = C.op8_template_compiler(spark, path)
    con = duckdb.connect()
    turns = table(spark, path, "conversations").select("conv_id", "turn", "role", "text").toPandas()
    turns = turns.astype({"conv_id": "Int64", "turn": "Int64"})
    con.register("conversations", turns)
    answer = con.sql(C.OP8_SQL)
    assert answer.columns == spark_rows.columns
    assert sorted(map(repr, answer.fetchall())) == sorted(repr(tuple(r)) for r in spark_rows.collect())


def test_pieces_join_to_the_formatted_text(spark, odd_dir):
    pieces = C.formatted(table(spark, odd_dir, "conversations")).collect()
    digest = {r.conv_id: r for r in C.read_back(table(spark, odd_dir, "conversations")).collect()}
    for conv in digest:
        own = sorted((p for p in pieces if p.conv_id == conv), key=lambda p: p.piece)
        text = "".join(p.text for p in own)
        assert len(text) == digest[conv].formatted_chars
        assert all(text[p.start : p.start + len(p.text)] == p.text for p in own)
        learned = "".join(C.unescape(p.text) for p in own if p.learned)
        assert hashlib.sha256(learned.encode()).hexdigest() == digest[conv].loss_sha256
