"""Exact top-k and near-duplicate vectors against brute force."""

from collections import defaultdict

import numpy as np
import pytest

from test_dedup import roots
from weftline.llm import bitslice, nndescent

SCHEMA = "vec_id long, embedding array<float>, label int, score string, id string, q string"


def rows(n=400, d=16, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 0.25, (n, d)).astype(np.float32)
    x[10:20] = x[10]
    x[50:90] = x[50] + rng.normal(0, 0.02, (40, d))
    x[100] = 3 * x[101]
    out = [(i, x[i].tolist(), 0, "x", "x", "x") for i in range(n)]
    bad = [None, [], [0.0] * d, [float("nan")] * d, [float("inf")] + [0.0] * (d - 1), [None] + [1.0] * (d - 1)]
    out += [(1000 + i, v, 0, "x", "x", "x") for i, v in enumerate(bad)]
    return out + [out[0], out[10], (2000, x[0][:8].tolist(), 0, "x", "x", "x"), (None, x[3].tolist(), 0, "x", "x", "x")]


def usable(v, width):
    return v is not None and all(c is not None and np.isfinite(c) for c in v)


def pad(v, width):
    return np.array([*v, *[0.0] * (width - len(v))], np.float32).astype(float)


@pytest.mark.parametrize("block,chunk", [(4096, 64), (50, 7)])
def test_top_k_is_exact(spark, block, chunk):
    data = rows()
    vectors = spark.createDataFrame(data, SCHEMA).repartition(3)
    got = defaultdict(list)
    for r in bitslice.top_k(vectors, vectors.where("vec_id % 50 = 0"), 5, block, chunk).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    known = {(i, tuple(v)) for i, v, *_ in data if i is not None and usable(v, 16)}
    q = {i: np.floor(256 * pad(v, 16)).astype(int) for i, v in known}
    want = {}
    for i in q:
        if i % 50 == 0:
            order = sorted(((-int(q[i] @ q[j]), j) for j in q if j != i))[:5]
            want[i] = [(n + 1, j, -s) for n, (s, j) in enumerate(order)]
    assert {i: sorted(v) for i, v in got.items()} == want


def test_top_k_of_few_and_none(spark):
    few = spark.createDataFrame([(50, [1.0, -2.0]), (7, [0.5, 0.5]), (8, [-1.0, 2.5])], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in bitslice.top_k(few, few.where("vec_id = 50")).orderBy("rank").collect()]
    assert got == [(50, 1, 7, 128 * 256 - 128 * 512), (50, 2, 8, -256 * 256 - 512 * 640)]
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert bitslice.top_k(none, none).count() == 0


def test_slices_take_large_components():
    rng = np.random.default_rng(1)
    import pandas as pd
    x = rng.integers(-2**20, 2**20, (100, 5))
    block = bitslice.sliced(pd.DataFrame({"block": 0, "vec_id": np.arange(100), "q": list(x)})).iloc[0]
    place, row, score = bitslice.search(block, x[:3], np.arange(3), 4)
    for i in range(3):
        full = sorted((-int(x[i] @ x[j]), j) for j in range(100) if j != i)[:4]
        assert sorted((-s, r) for p, r, s in zip(place, row, score) if p == i) == full


@pytest.mark.parametrize("block,chunk", [(4096, 64), (30, 3)])
def test_top_k_keeps_large_components(spark, block, chunk):
    """Components beyond the index, as queries and as candidates, beside the rows that it takes."""
    rng = np.random.default_rng(8)
    x = rng.normal(0, 2, (100, 6))
    x[50, 2], x[7, 1], x[9], x[11, 0], x[12, 3] = 5e3, -1e6, 4096.0, 2.0**40, -4096.001
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    got = defaultdict(list)
    for r in bitslice.top_k(vectors, vectors.where("vec_id % 25 = 0"), 5, block, chunk).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    q = [[int(np.floor(256 * c)) for c in v] for v in x]
    want = {}
    for i in range(0, 100, 25):
        order = sorted((-sum(a * b for a, b in zip(q[i], q[j])), j) for j in range(100) if j != i)[:5]
        want[i] = [(n + 1, j, -s) for n, (s, j) in enumerate(order)]
    assert {i: sorted(v) for i, v in got.items()} == want


def test_products_of_any_size():
    a, b = bitslice.whole([[1e300, -0.5], [3.0]]), bitslice.whole([[2.0**60, 1.0], [0.0, -1.0]])
    assert bitslice.products(a, b).tolist() == [
        [int(1e300) * 256 * 2**68 - 128 * 256, 128 * 256], [768 * 2**68, 0]]


def brute_links(data, threshold=0.9):
    seen = {(i, tuple(v)): None for i, v, *_ in data if i is not None and usable(v, 16) and any(v)}
    keys = list(seen)
    x = np.stack([pad(v, 16) for _, v in keys])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    return keys, near


def test_near_vectors_match_brute_force(spark):
    data = rows()
    got = nndescent.near_duplicates(spark.createDataFrame(data, SCHEMA).repartition(3)).collect()
    assert len(got) == len(data)
    keys, near = brute_links(data)
    group = roots({i for i, *_ in data if i is not None}, [(keys[a][0], keys[b][0]) for a, b in zip(*np.nonzero(near))])
    n = {key[0]: int(near[k].sum()) for k, key in enumerate(keys)}
    for r in got:
        if r["vec_id"] is not None:
            assert (r["n_links"], r["component_id"], r["kept"]) == (n.get(r["vec_id"], 0), group[r["vec_id"]], r["vec_id"] == group[r["vec_id"]]), r
        else:
            assert not r["kept"]


def test_vectors_of_one_id_are_nodes_of_their_own(spark):
    """Id 5 has two vectors, each with a near copy of another id; a null id and an equal row are beside them."""
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    data = [(5, a), (5, b), (2, [1.0, 0.1, 0.0]), (9, [0.1, 1.0, 0.0]), (5, a), (7, b), (8, [0.0, 0.0, 1.0]), (None, a)]
    got = sorted((r["vec_id"] or -1, r["n_links"], r["component_id"], r["kept"])
                 for r in nndescent.near_duplicates(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect())
    assert got == sorted([(5, 1, 2, False), (5, 1, 2, False), (2, 1, 2, True), (5, 2, 5, True), (9, 2, 5, False), (7, 2, 5, False),
                          (8, 0, 8, True), (-1, 1, 2, False)])


def test_full_lists_are_counted_whole(spark):
    """Two clouds of near copies, each far larger than a neighbour list and a tile."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(2, 16))
    x = np.concatenate([c + rng.normal(0, 0.05, (60, 16)) for c in centres] + [rng.normal(size=(80, 16))])
    data = [(i, v.tolist()) for i, v in enumerate(x)]
    old, nndescent.TILE_ROWS = nndescent.TILE_ROWS, 16
    try:
        got = {r["vec_id"]: r["n_links"] for r in nndescent.near_duplicates(
            spark.createDataFrame(data, "vec_id long, embedding array<double>"), neighbours=5).collect()}
    finally:
        nndescent.TILE_ROWS = old
    keys, near = brute_links(data)
    assert got == {key[0]: int(near[k].sum()) for k, key in enumerate(keys)}


def audit_case(spark):
    """A hot component of 150 counted whole, 40 pairs of which no link was found, and 60 vectors without a link."""
    x = np.zeros((290, 101))
    x[:150, 0] = 1
    for p in range(40):
        x[150 + 2 * p:152 + 2 * p, 1 + p] = 1
    x[230:, 41:] = np.eye(60)
    nodes = spark.createDataFrame([(i, 1, bytearray(v.tobytes())) for i, v in enumerate(x)], "id long, times long, unit binary")
    links = spark.createDataFrame([(i, 149) for i in range(150)], "id long, n long")
    groups = spark.createDataFrame([(i, 0) for i in range(150)], "id long, component long")
    return nodes, links, groups


def test_audit_sees_small_groups_beside_a_hot_one(spark):
    assert nndescent.audited(*audit_case(spark), 0.9, 256) == 0


def test_audit_samples_until_nodes_have_links(spark):
    """Only one node in many has a link, and that link is missing."""
    x = np.eye(200)
    x[199] = x[198]
    nodes = spark.createDataFrame([(i, 1, bytearray(v.tobytes())) for i, v in enumerate(x)], "id long, times long, unit binary")
    none = spark.createDataFrame([], "id long, n long")
    assert nndescent.sampled_recall(nodes, nodes, none, 0.9, 2) == 0
    assert nndescent.sampled_recall(nodes.where("id < 198"), nodes, none, 0.9, 2) == 1


def test_low_recall_is_an_error(spark, monkeypatch):
    """The lists grow, and rows of an answer that stays below the target are not returned."""
    monkeypatch.setattr(nndescent, "audited", lambda *_: 0.5)
    monkeypatch.setattr(nndescent, "MAX_ROUNDS", 1)
    few = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(6)], "vec_id long, embedding array<double>")
    with pytest.raises(RuntimeError, match="recall 0.500"):
        nndescent.near_duplicates(few)


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert nndescent.near_duplicates(none).count() == 0
    bad = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in nndescent.near_duplicates(bad).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_top_k_joins_no_exploded_chunks(spark):
    """No side of a join holds chunks times blocks, which Spark could take for small and send to the driver; tasks are bounded."""
    vectors = spark.createDataFrame(rows(), SCHEMA)
    found = bitslice.top_k(vectors, vectors, 5, 4, 4)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    blocks = spark.createDataFrame([(b, b"", b"", b"", b"") for b in range(150) if b != 7], bitslice.BLOCK_SCHEMA)
    chunks = spark.range(90).selectExpr("id AS chunk_no", "array(named_struct('vec_id', id, 'q', array(1))) AS chunk")
    both = bitslice.met(blocks, chunks, 150, 90)
    assert both.rdd.getNumPartitions() <= max(4, 4 * spark.sparkContext.defaultParallelism)
    # Each chunk meets each block once, after the block's own row.
    open_block, pairs = None, []
    for part in both.rdd.glom().collect():
        for r in part:
            if r["chunk"] is None:
                open_block = (r["block"], r["share"])
            elif open_block == (r["block"], r["share"]):
                pairs.append((r["block"], r["chunk_no"]))
    assert sorted(pairs) == [(b, c) for b in range(150) if b != 7 for c in range(90)]
