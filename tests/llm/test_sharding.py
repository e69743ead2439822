import zlib
from bisect import bisect_left, bisect_right
from math import ceil

import numpy as np
import pytest

from siltstone.llm import sharding as S
from siltstone.llm.common import table
from tests.conftest import SMALL
from tests.llm.conftest import ODD_DOCS


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_each_cell_and_moves_by_one(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij")).reshape(dims, -1)
    index = S.curve_index(list(cells), bits)
    assert sorted(index) == list(range(1 << (bits * dims)))
    steps = np.abs(np.diff(cells[:, np.argsort(index)], axis=1)).sum(axis=0)
    assert set(steps) == {1}


def _check(rows, docs):
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in rows) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs
    )
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(s, ())) for s in range(16)]
    assert max(counts) - min(counts) <= 1
    order = sorted(rows, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in order] == sorted(r.curve for r in rows)


def test_all_documents_in_runs_along_the_curve(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SMALL, "documents").collect()]
    _check(S.op1_hilbert_shards(spark, SMALL).collect(), docs)


def _edges(values, cells):
    known = sorted(v for v in values if v is not None)
    if known and isinstance(known[0], str):
        firsts = {}
        for v in sorted(set(known)):
            middle = bisect_left(known, v) + known.count(v) / 2
            firsts.setdefault(int(middle * cells / len(known)), v)
        return sorted(firsts.values())[1:]
    return sorted({known[ceil(len(known) * k / cells) - 1] for k in range(1, cells)}) if known else []


@pytest.mark.parametrize("odd", [False, True])
def test_cells_equal_brute_force(spark, odd_dir, odd):
    where = odd_dir if odd else SMALL
    docs = S.with_size(table(spark, where, "documents")).select("doc_id", "text_crc32", *set(S.DIMENSIONS) - {"doc_id"}).collect()
    edges = {d: _edges([r[d] for r in docs], 1 << S.BITS) for d in S.DIMENSIONS}
    cells = [[0 if r[d] is None else bisect_right(edges[d], r[d]) for r in docs] for d in S.DIMENSIONS]
    curve = S.curve_index([np.array(c) for c in cells], S.BITS)
    expected = sorted((repr(r.doc_id), r.text_crc32, int(c)) for r, c in zip(docs, curve, strict=True))
    got = S.op1_hilbert_shards(spark, where).collect()
    assert sorted((repr(r.doc_id), r.text_crc32, r.curve) for r in got) == expected


def test_odd_rows(spark, odd_dir):
    _check(S.op1_hilbert_shards(spark, odd_dir).collect(), [r[:2] for r in ODD_DOCS])


def test_nothing(spark, empty_dir):
    assert S.op1_hilbert_shards(spark, empty_dir).count() == 0


def test_files_are_pruned_by_any_dimension(spark, tmp_path):
    sharded = S.shards(table(spark, SMALL, "documents"))
    S.write_shards(sharded, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 200 and back.select("shard").distinct().count() == 16
    for folder in (tmp_path / "out").glob("shard=*"):
        slots = [slot for name in sorted(folder.glob("*.parquet")) for (slot,) in spark.read.parquet(str(name)).select("slot").collect()]
        assert slots == list(range(len(slots)))
    manifest = S.manifest(back)
    for ranges in ({"size": (0, 500)}, {"doc_id": (0, 40)}, {"source": ("src8", "src9")}):
        kept = {r.shard for r in S.candidates(manifest, **ranges).collect()}
        matching = back
        for c, (low, high) in ranges.items():
            matching = matching.where(f"{c} BETWEEN '{low}' AND '{high}'")
        assert {r.shard for r in matching.collect()} <= kept
        assert len(kept) < 16
