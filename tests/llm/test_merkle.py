import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from siltstone.llm import merkle as M
from siltstone.llm.common import table
from tests.conftest import SMALL
from tests.llm.conftest import DOCS


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(row):
    """Every level of the tree over a row of digests."""
    levels = [row]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H("".join(last[i : i + 3])) for i in range(0, len(last), 3)])
    return levels


def siblings(levels, i):
    out = []
    for row in levels[:-1]:
        first = i - i % 3
        out.append(("".join(row[first:i]), "".join(row[i + 1 : first + 3])))
        i //= 3
    return out


def plain(docs):
    """The contract, with whole lists."""
    sources = {}
    for r in docs:
        own = [r.doc_id, r.source, r.lang, r.n_chars, r.text]
        leaf = H("".join(map(field, own)))
        if r.doc_id is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0:
            own[-1] = r.text.replace("\n", "")
        claim = H("".join(map(field, own)))
        sources.setdefault(r.source, []).append((r.doc_id, leaf, claim))
    keys = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in keys:
        sources[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = climb([leaf for _, leaf, _ in sources[s]])
    top = climb([trees[s][-1][0] for s in keys])
    out = []
    for at, s in enumerate(keys):
        for i, (doc_id, leaf, claim) in enumerate(sources[s]):
            path = siblings(trees[s], i) + siblings(top, at)
            folded = claim
            for left, right in path:
                folded = H(left + folded + right)
            proof = H("".join(left + right for left, right in path))
            out.append((doc_id, leaf, trees[s][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("levels", range(1, 8))
def test_addresses_are_a_van_emde_boas_layout(levels):
    places = [int(M.address(levels, d, i)) for d in range(levels) for i in range(3**d)]
    assert sorted(places) == list(range(M.nodes_in(levels)))
    top = levels // 2
    if top:  # the upper half is together at the start, each lower subtree together behind it
        upper = [int(M.address(levels, d, i)) for d in range(top) for i in range(3**d)]
        assert sorted(upper) == list(range(M.nodes_in(top)))
        size = M.nodes_in(levels - top)
        for s in range(3**top):
            lower = [int(M.address(levels, top, s))]
            if levels - top > 1:
                lower += [int(M.address(levels, top + 1, 3 * s + j)) for j in range(3)]
            assert {(p - M.nodes_in(top)) // size for p in lower} == {s}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 26, 27, 28, 81])
def test_paths_of_a_block_fold_to_its_root(n):
    leaves = [hashlib.sha256(bytes([i])).digest() for i in range(n)]
    height = M.height_of(n)
    for h in (height, height + 2):
        cells = M.build(leaves, h)
        found = M.paths(cells, h, n)
        assert {M.fold(leaf, p) for leaf, p in zip(leaves, found, strict=True)} == {cells[:32]}
    assert M.build(leaves, height)[:32].hex() == climb([x.hex() for x in leaves])[-1][0]


def test_all_documents(spark):
    docs = table(spark, SMALL, "documents").collect()
    got = found(M.op11_merkle_manifest(spark, SMALL))
    assert got == plain(docs)
    assert 0 < sum(r[-1] for r in got) < len(got)


def claims():
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(hit, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def test_many_rounds_of_small_blocks(spark):
    """Sources of 1 to 120 rows in blocks of 3, so that a tree takes up to five rounds."""
    sizes = [1, 2, 3, 4, 9, 10, 27, 28, 81, 82, 120, 7]
    rows = [(1000 * s + i, f"a\n{i}", "en", f"s{s}" if s else None, i) for s, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, DOCS)
    made = M.manifest(docs, claims(), height=1)
    assert len(made.sources.rounds) == 5 and len(made.top.rounds) == 3
    assert found(M.check(made)) == plain(docs.collect())


def test_a_source_of_several_blocks(spark):
    rows = [(i, f"x {i}" + "\n" * (i % 3), "en", "big" if i % 4 else f"s{i % 8}", None) for i in range(3200)]
    docs = spark.createDataFrame(rows, DOCS)
    made = M.manifest(docs, claims())
    assert len(made.sources.rounds) == 2
    assert found(M.check(made)) == plain(docs.collect())
    assert M.check(M.manifest(docs)).where("NOT verified").count() == 0


def test_odd_rows(spark, odd_dir):
    docs = table(spark, odd_dir, "documents").collect()
    assert found(M.op11_merkle_manifest(spark, odd_dir)) == plain(docs)


def test_nothing(spark, empty_dir):
    got = M.op11_merkle_manifest(spark, empty_dir)
    assert got.count() == 0 and got.columns[-1] == "verified"
    assert M.manifest(table(spark, empty_dir, "documents")) is None


def test_one_document(spark):
    docs = spark.createDataFrame([(5, "a\nb", None, None, None)], DOCS)
    row = M.check(M.manifest(docs)).first()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.proof_sha256 == H("")
