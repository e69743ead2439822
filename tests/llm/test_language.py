import zlib

import numpy as np
import pytest

from siltstone.llm import language as L
from siltstone.llm.common import table
from tests.conftest import SMALL
from tests.llm.conftest import ODD_DOCS

MIDDLE = "/root/testdata/sf0.01"


def test_held_out_documents_are_recognised(spark):
    got = {r.doc_id: r for r in L.op3_language_mixture(spark, MIDDLE).collect()}
    docs = table(spark, MIDDLE, "documents").collect()
    assert len(got) == len(docs) == 1000
    out = [d for d in docs if zlib.crc32(str(d.doc_id).encode()) % 4 == 2]
    assert {d.doc_id for d in out} == {i for i, r in got.items() if r.held_out}
    right = sum(got[d.doc_id].lang_pred == d.lang for d in out)
    assert right / len(out) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_labels_of_held_out_documents_are_not_used(spark):
    docs = table(spark, SMALL, "documents")
    swapped = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 'zz' ELSE lang END AS lang")
    one, two = L.learn(docs), L.learn(swapped)
    assert one[0] == two[0] and np.array_equal(one[1], two[1])


def test_mixtures_get_their_languages_and_shares(spark):
    docs = table(spark, MIDDLE, "documents")
    langs, model = L.learn(docs)
    letters = L._letters()
    own = {}
    for r in docs.where("length(text) > 2000").collect():
        own.setdefault(r.lang, []).append(r.text[:2000])
    text = own["en"][0][:1500] + " " + own["de"][0][:500]
    counts = np.bincount(L.trigrams(text, letters), minlength=L.BUCKETS)[None].astype(float)
    parts = dict(zip(langs, L.infer(counts, model)[0], strict=True))
    assert parts["fr"] == parts["es"] == 0
    assert parts["en"] == pytest.approx(0.75, abs=0.1) and parts["de"] == pytest.approx(0.25, abs=0.1)
    single = np.bincount(L.trigrams(own["fr"][0], letters), minlength=L.BUCKETS)[None].astype(float)
    assert L.infer(single, model)[0][langs.index("fr")] == 1


def test_likelihood_never_falls():
    rng = np.random.default_rng(1)
    model = rng.dirichlet(np.ones(L.BUCKETS), size=3).T
    counts = rng.integers(0, 5, size=(4, L.BUCKETS)).astype(float)
    every = np.ones((4, 3))
    before = (counts * np.log(every / 3 @ model.T)).sum(axis=1)
    parts, reached = L.proportions(counts, model, every)
    assert (reached >= before).all() and np.allclose(parts.sum(axis=1), 1)


def test_odd_rows(spark, odd_dir):
    got = L.op3_language_mixture(spark, odd_dir).collect()
    assert len(got) == len(ODD_DOCS)
    unknown = {r.doc_id for r in got if r.lang_pred == "und"}
    assert unknown == {3, 4, 5, 6, None} and all(r.score == 0 for r in got if r.lang_pred == "und")
    assert {r.lang_pred for r in got} <= {"en", "de", "fr", "und"}
    kept = L.recognised(table(spark, odd_dir, "documents"))
    assert kept.columns == table(spark, odd_dir, "documents").columns
    assert kept.where("rank <> 7 OR _id <> 7").count() == 0
    assert sum(r.doc_id is None for r in kept.collect()) == 1


def test_nothing(spark, empty_dir):
    assert L.op3_language_mixture(spark, empty_dir).count() == 0


def test_nothing_learned(spark, odd_dir):
    docs = table(spark, odd_dir, "documents").selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    langs, model = L.learn(docs)
    assert {r.lang_pred for r in L.predicted(docs, ["doc_id"], langs, model).collect()} == {"und"}
