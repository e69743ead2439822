import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import fingerprints as P
from siltstone.llm.common import table
from tests.conftest import SMALL
from tests.llm.conftest import LONG, ODD_DOCS


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, start=1):
        before, row = row, [i]
        for j, y in enumerate(b, start=1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


@given(st.text("ABC", max_size=90), st.text("ABC", max_size=90))
@settings(max_examples=300, deadline=None)
def test_edit_distance_equals_the_table(a, b):
    assert P.edit_distance(a, b) == _distance(a, b)


def _edited(docs):
    ordered = sorted(docs, key=lambda d: d[0])
    out = {}
    for k, (i, text) in enumerate(ordered):
        after, n = ordered[(k + 1) % len(ordered)][1], len(text)
        out[i] = (n, hashlib.sha256((text[: n - n // 2] + after[: n // 2]).encode()).hexdigest(), after)
    return out


def test_all_documents_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in table(spark, SMALL, "documents").collect()}
    got = {r.doc_id: r for r in P.op5_piecewise_hashes(spark, SMALL).collect()}
    expected = _edited(list(docs.items()))
    assert got.keys() == expected.keys()
    for i, r in got.items():
        assert (r.n_chars, r.edited_sha256) == expected[i][:2]
        assert r.fingerprint == P.fingerprint(docs[i])
        assert r.near_next == P.likeness(r.fingerprint, P.fingerprint(expected[i][2]))
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
    assert sum(r.near_edited > r.near_next for r in got.values()) / len(got) > 0.97


def test_an_edit_changes_few_signs():
    rng = random.Random(3)
    text = " ".join(f"w{rng.randrange(5000)}" for _ in range(2000))
    other = " ".join(f"v{rng.randrange(5000)}" for _ in range(2000))
    half = len(text) // 2
    assert P.likeness(P.fingerprint(text), P.fingerprint(text[:half] + "inserted " + text[half:])) > 0.9
    assert P.likeness(P.fingerprint(text), P.fingerprint(other)) < 0.3
    assert P.likeness(P.fingerprint(text), P.fingerprint(text + text[: len(text) // 3])) > 0.5
    assert P.likeness("8:AB:C", "64:AB:C") == 0 and P.likeness("8:AB:CD", "16:CD:E") == 1


def test_signs_stay_few_in_any_text():
    for text in ("a" * 100_000, "ab" * 50_000, LONG, "x", "", "é" * 5000):
        block, signs, twice = P.fingerprint(text).split(":")
        assert len(signs) <= P.MANY and len(twice) <= P.MANY and int(block) >= 1
    assert P.fingerprint("") == "1::" and P.likeness("1::", "1::") == 1
    assert P.likeness("1::", P.fingerprint("text")) == 0


def test_ranges_of_ids_meet(spark, with_conf):
    """Neighbours in different partitions see each other, whatever the order of the rows."""
    rng = random.Random(6)
    docs = [(i * 3 - 50, "".join(rng.choice("abc ") for _ in range(rng.randrange(40)))) for i in range(90)]
    rng.shuffle(docs)
    for tasks in ("1", "5", "40"):
        with_conf(spark__sql__shuffle__partitions=tasks)
        got = P.compared_with_next(spark.createDataFrame(docs, "doc_id long, text string")).collect()
        expected = _edited(docs)
        assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == {i: e[:2] for i, e in expected.items()}
        assert len(got) == 90


def test_odd_rows(spark, odd_dir):
    got = P.op5_piecewise_hashes(spark, odd_dir).collect()
    assert sorted(r.n_chars for r in got) == sorted(len(r[1] or "") for r in ODD_DOCS)
    same = {r.fingerprint for r in got if r.doc_id in (1, 2)}
    assert len(same) == 1
    one = spark.createDataFrame([(5, "abcd")], "doc_id long, text string")
    assert P.compared_with_next(one).first().near_next == 1


def test_nothing(spark, empty_dir):
    assert P.op5_piecewise_hashes(spark, empty_dir).count() == 0
