import math

import numpy as np
import pytest
from llm_rows import by_row
from pyspark.sql import functions as F

from marginflow.llm import negatives as ng

OUT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, is_anchor, positives=5, keep=10):
    """rows: (id, label, whole numbers)."""
    out = []
    for a, la, va in rows:
        if not is_anchor(a):
            continue
        scored = [(sum(x * y for x, y in zip(va, v, strict=True)), i, lb) for i, lb, v in rows if i != a and len(v) == len(va)]
        first = sorted((-s, i) for s, i, lb in scored if lb == la)[:positives]
        for minus, p in first:
            fits = sorted((-s, i) for s, i, lb in scored if lb != la and 30 * -minus <= 100 * s <= 90 * -minus)[:keep]
            out += [(a, p, n + 1, i, -minus, -s) for n, (s, i) in enumerate(fits)]
    return sorted(out, key=repr)


def whole(vectors):
    return [[math.floor(256 * x) for x in v] for v in vectors]


def clustered(n, dims, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dims))
    vectors = centres[rng.integers(0, 6, n)] + 0.4 * rng.normal(size=(n, dims))
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).tolist(), rng.integers(0, 4, n).tolist()


def frame(spark, rows):
    return spark.createDataFrame([(i, label, v, "x", 1, 2) for i, label, v in rows],
                                 "vec_id long, label int, embedding array<double>, grp string, query int, v int")


@pytest.mark.parametrize("leaf,group", [(4, 50), (64, 1 << 19)])
def test_against_brute_force(spark, monkeypatch, leaf, group):
    monkeypatch.setattr(ng, "LEAF", leaf)
    monkeypatch.setattr(ng, "GROUP_ROWS", group)
    vectors, labels = clustered(700, 6, 3)
    vectors[20:160] = [vectors[0]] * 140  # one vector in many rows: ties by id
    rows = list(zip(range(700), labels, vectors, strict=True))
    got = ng.mine(frame(spark, rows), anchors=F.col("vec_id") % 20 == 0)
    want = brute(list(zip(range(700), labels, whole(vectors), strict=True)), lambda i: i % 20 == 0)
    assert by_row(got, *OUT) == want and len(want) > 100


def test_pack_and_boxes():
    rng = np.random.default_rng(1)
    vectors = rng.integers(-50, 50, (1000, 5))
    order = ng.pack(vectors, 16)
    assert sorted(order.tolist()) == list(range(1000))
    leaves = [(order[at:at + 16], vectors[order[at:at + 16]].astype(float)) for at in range(0, 1000, 16)]
    tree = ng.Tree(leaves)
    query = ng.Query(-1, rng.integers(-9, 9, 5).astype(float))
    for level, (low, _) in enumerate(tree.levels):
        least, greatest = tree.reach(level, 0, len(low), query)
        span = ng.FANOUT ** level
        for i in range(len(low)):
            scores = np.concatenate([v @ query.vector for _, v in leaves[i * span:(i + 1) * span]])
            assert least[i] <= scores.min() and scores.max() <= greatest[i]
    volume = np.prod([v.max(0) - v.min(0) + 1 for _, v in leaves], axis=1).mean()
    loose = np.prod([vectors[a:a + 16].max(0) - vectors[a:a + 16].min(0) + 1 for a in range(0, 1000, 16)], axis=1).mean()
    assert volume < loose / 4  # packed boxes are tight


def test_search_prunes_and_stays_exact():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-100, 100, (4000, 3))
    order = ng.pack(vectors, 16)
    tree = ng.Tree([(order[a:a + 16], vectors[order[a:a + 16]].astype(float)) for a in range(0, 4000, 16)])
    for trial in range(40):
        vector = rng.integers(-30, 30, 3)
        scores = vectors @ vector
        low, high = sorted(rng.integers(-6000, 6000, 2).tolist())
        query = ng.Query(7, vector.astype(float))
        want = sorted((-s, i) for i, s in enumerate(scores.tolist()) if low <= s <= high and i != 7)[:5]
        assert ng.search(query, [tree], 5, low, high) == [(-s, i) for s, i in want]
        floor = -want[2][0] if len(want) > 2 else -math.inf
        bound = ng.search(query, [tree], 5, low, high, floor)
        assert [x for x in bound if x[0] >= floor] == [(-s, i) for s, i in want if -s >= floor]
        if trial == 0:
            free = ng.Query(-1, vector.astype(float))
            ng.search(free, [tree], 5, -math.inf, math.inf)
            assert len(free.scores) < len(tree.leaves) / 3


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.5]), (100, 1, [1.0, 0.5]), (1, 1, [0.9, 0.1]), (1, 1, [0.9, 0.1]), (2, 2, [0.5, 0.2]), (2, 2, [0.5, 0.2]),
            (3, 2, [0.4, None]), (4, 2, [nan, 0.1]), (5, 2, [inf, 0.1]), (6, None, [0.5, 0.2]), (7, 2, None), (None, 2, [0.5, 0.2]),
            (8, 2, [0.5]), (9, 2, []), (200, 1, []), (10, 1, []), (300, 5, [0.3, 0.3]), (11, 2, [-0.9, 0.0])]
    sound = [(i, label, whole([v])[0]) for i, label, v in rows if i not in (3, 4, 5, 6, 7, None)]
    got = ng.mine(frame(spark, rows), anchors=F.col("vec_id") % 100 == 0)
    assert by_row(got, *OUT) == brute(sound, lambda i: i % 100 == 0)
    assert got.columns == OUT
    assert ng.mine(frame(spark, rows).where("false"), anchors=F.col("vec_id") % 100 == 0).count() == 0
    assert ng.mine(frame(spark, rows), anchors=F.lit(False)).count() == 0
    with pytest.raises(Exception, match="too large"):
        ng.mine(frame(spark, [(1, 1, [1e30])]), anchors=F.lit(True)).count()


def test_query(spark):
    from marginflow.llm.queries import op12_negatives

    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    changed = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, whole([r.embedding])[0]) for r in rows]
    assert by_row(op12_negatives(spark, "/root/testdata/sf0.01"), *OUT) == brute(changed, lambda i: i % 100 == 0)
