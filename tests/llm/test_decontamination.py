import hashlib
import random

from siltstone.llm import decontamination as D
from siltstone.llm.common import table
from tests.conftest import SMALL
from tests.llm.conftest import ODD_DOCS, WORD, lower, words


def _brute(docs, items, width=10):
    owners = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - width + 1)) if w else ():
            owners.setdefault(tuple(w[i : i + width]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, own = words(text), set(), set()
        for n in {len(k) for k in owners}:
            for i in range(len(w) - n + 1):
                ids = owners.get(tuple(w[i : i + n]))
                if ids:
                    own |= ids
                    hit |= set(range(i, i + n))
        sha = hashlib.sha256(",".join(sorted(own)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(own), sha, bool(hit)))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def test_hits_equal_the_sql(spark, duck):
    got = D.op10_benchmark_windows(spark, SMALL).select(COLUMNS).collect()
    assert sorted(map(tuple, got)) == sorted(duck.sql(D.OP10_SQL).project(", ".join(COLUMNS)).fetchall())
    assert any(r.contaminated for r in got)


def test_odd_rows_equal_brute_force(spark, odd_dir):
    got = D.op10_benchmark_windows(spark, odd_dir).select(COLUMNS).collect()
    items = [tuple(r) for r in table(spark, odd_dir, "benchmark").select("item_id", "text").collect()]
    assert sorted(map(tuple, got), key=repr) == _brute([r[:2] for r in ODD_DOCS], items)


def test_several_automata_find_the_same(spark):
    docs, items = table(spark, SMALL, "documents"), table(spark, SMALL, "benchmark")
    n = sum(len(r.pattern) for r in D.blocks(items).collect())
    split = D.searched(docs, items, ["doc_id"], limit=n // 3)
    whole = D.searched(docs, items, ["doc_id"])
    def show(df):
        return sorted((r.doc_id, D._merged(r._hits), r._items) for r in df.collect())
    assert show(split) == show(whole)


def test_spans_point_into_the_original_text(spark):
    item = "Alpha beta gamma delta epsilon zeta eta theta iota kappa"
    text = "Été! ALPHA, beta; gamma-delta\nepsilon zeta (eta) theta iota KAPPA... omega"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = D.contamination(docs, spark.createDataFrame([(9, item)], "item_id long, text string")).first()
    start, end = map(int, got.hit_spans.split(":"))
    assert text[start:end].startswith("ALPHA") and text[start:end].endswith("KAPPA")
    assert (got.n_hit, got.n_words, got.n_items) == (10, 12, 1)
    assert WORD.findall(lower("AÉb"))


def test_clean_documents_stay_with_their_columns(spark, odd_dir, empty_dir):
    docs = table(spark, odd_dir, "documents")
    kept = D.clean(docs, table(spark, odd_dir, "benchmark"))
    assert kept.columns == docs.columns and kept.where("_hits <> 7").count() == 0
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(
        (r[0] or -1) for r in _brute([r[:2] for r in ODD_DOCS], [tuple(r) for r in table(spark, odd_dir, "benchmark").select("item_id", "text").collect()]) if not r[5]
    )
    assert D.clean(docs, table(spark, empty_dir, "benchmark")).count() == docs.count()
    assert D.op10_benchmark_windows(spark, empty_dir).count() == 0


def test_windows_in_repetitive_texts_equal_brute_force(spark):
    rng = random.Random(5)

    def text(n):
        return " ".join(rng.choice("abc") for _ in range(n))

    for width in (1, 2, 3, 6):
        items = [(i, text(rng.choice([1, 2, 3, 5, 6, 7, 20]))) for i in range(12)]
        docs = [(i, text(rng.choice([1, 2, 5, 9, 40]))) for i in range(40)]
        made = spark.createDataFrame(items, "item_id long, text string")
        got = D.searched(spark.createDataFrame(docs, "doc_id long, text string"), made, ["doc_id"], width)
        found = []
        for r in got.collect():
            hit = {k for a, b in D._merged(r._hits) for k in range(a, b)}
            found.append((r.doc_id, len(words(r.text)), len(hit), *_named(D._ids(r._items)), bool(hit)))
        assert sorted(found, key=repr) == _brute(docs, items, width)


def _named(ids):
    return len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
