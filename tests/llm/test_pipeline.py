import importlib
import re
import sys
from collections import Counter
from pathlib import Path

import __spark_entry__ as spark_entry
import corpus_pipeline
from siltstone.llm import decontamination, language, mixing
from siltstone.llm.common import table
from siltstone.sources.staging import stage
from tests.conftest import SMALL
from tests.llm.conftest import near_classes, words


def _through(spark, where):
    docs = table(spark, where, "documents")
    out = [docs]
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, where), name).df
        out.append(docs)
    return out


def test_stages_against_brute_force(spark):
    docs, known, single, clean, mixed, sharded = _through(spark, SMALL)
    for kept in (known, single, clean, mixed):
        assert kept.columns == docs.columns
    letters = [r.doc_id for r in docs.collect() if re.search(r"[^\W\d_]", r.text or "")]
    assert sorted(r.doc_id for r in known.collect()) == sorted(letters)
    classes = near_classes([(r.doc_id, r.text) for r in known.collect()])
    assert sorted(r.doc_id for r in single.collect()) == sorted({c for c in classes.values()})
    windows = set()
    for (text,) in table(spark, SMALL, "benchmark").select("text").collect():
        w = words(text)
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))}
    widths = {len(w) for w in windows}
    free = []
    for r in single.collect():
        w = words(r.text)
        if not any(tuple(w[i : i + n]) in windows for n in widths for i in range(len(w) - n + 1)):
            free.append(r.doc_id)
    assert sorted(r.doc_id for r in clean.collect()) == sorted(free)
    taken = mixing.mixed(clean).collect()
    copies = Counter(r.doc_id for r in taken if r.size and 2 * r.taken >= r.size)
    assert Counter(r.doc_id for r in mixed.collect()) == copies
    rows = sharded.collect()
    assert Counter(r.doc_id for r in rows) == copies and sharded.columns[:5] == docs.columns
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1


def test_run_equals_its_stages(spark):
    last = _through(spark, SMALL)[-1]
    assert sorted(map(repr, corpus_pipeline.run(spark, SMALL).collect())) == sorted(map(repr, last.collect()))


def test_odd_and_empty_tables(spark, odd_dir, empty_dir):
    docs = table(spark, odd_dir, "documents")
    out = _through(spark, odd_dir)
    assert all(df.columns == docs.columns for df in out[1:-1])
    assert out[-1].where("rank <> 7 OR _uid <> 7").count() == 0
    assert out[1].count() > out[2].count() > 0
    assert corpus_pipeline.run(spark, empty_dir).count() == 0


def test_every_operator_is_registered():
    names = spark_entry.queries()
    assert sorted(int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))) == list(range(1, 14))
    assert "pipeline" in names and "pipeline" not in spark_entry.oracle_sql()
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    assert language and decontamination


def test_nothing_else_imports_the_subpackage():
    root = Path(__file__).resolve().parents[2]
    for path in [*(root / "siltstone").rglob("*.py"), *(root / "siltstone_checks").rglob("*.py")]:
        if "llm" not in path.parts:
            assert "siltstone.llm" not in path.read_text()


def test_entry_works_without_the_subpackage(monkeypatch):
    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda n, *a: None if "llm" in n or n == "corpus_pipeline" else real(n, *a))
    monkeypatch.delitem(sys.modules, "__spark_entry__")
    bare = importlib.import_module("__spark_entry__")
    assert not any(n.startswith("op") and n[2].isdigit() for n in bare.queries()) and "pipeline" not in bare.queries()
    monkeypatch.setitem(sys.modules, "__spark_entry__", spark_entry)
