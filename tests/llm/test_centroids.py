import hashlib
import math

import numpy as np
import pytest
from llm_rows import by_row

from marginflow.llm import centroids as ct


def brute(rows, k, rounds, scale, seed=1):
    """rows: (id, components); plain clustering with Python's whole numbers."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows]
    digest = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    centres = [v for _, v in sorted(((digest(i), v) for i, v in kept if i is not None))[:k]]
    for step in range(rounds + 1):
        near = []
        for _, v in kept:
            far = [sum((x - y) ** 2 for x, y in zip(v, c, strict=True)) for c in centres]
            near.append((min(far), far.index(min(far))))
        if step < rounds:
            for c in range(len(centres)):
                mine = [v for (_, v), (_, at) in zip(kept, near, strict=True) if at == c]
                if mine:
                    centres[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    return sorted(((i, c, d) for (i, _), (d, c) in zip(kept, near, strict=True)), key=repr), centres


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, cluster int, v int")


@pytest.mark.parametrize("cells", [ct.TABLE_CELLS, 10])
def test_against_brute_force(spark, monkeypatch, cells):
    monkeypatch.setattr(ct, "TABLE_CELLS", cells)
    rng = np.random.default_rng(5)
    vectors = np.round(rng.normal(size=(400, 5)), 2)
    vectors[50:190] = vectors[3]  # equal vectors, ties between equal centroids
    rows = list(zip(range(1000, 1400), vectors.tolist(), strict=True))
    got, centres = ct.cluster(frame(spark, rows), k=7, rounds=3, scale=8, dims=5)
    want, plain = brute(rows, 7, 3, 8)
    assert centres.tolist() == plain and by_row(got, "vec_id", "cluster", "distance") == want
    told = ct.with_totals(got, centres).collect()
    for r in told:
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster) and r.inertia == sum(d for _, _, d in want)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, plain[r.cluster])).encode()).hexdigest()


def test_tables_hold_squared_differences():
    values, centres = np.array([-3, 0, 5]), np.array([[1, 2], [-4, 0]])
    table = ct.tabulate(values, centres)
    assert table.shape == (2, 3, 2) and table[1, 2, 0] == 9 and table[0, 0, 1] == 1
    rows = np.array([[0, 5], [-3, -3]])
    assert ct.distances(np.searchsorted(values, rows), table).tolist() == [
        [int(((r - c) ** 2).sum()) for c in centres] for r in rows]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.5]), (1, [0.5, -0.5]), (1, [0.25, 0.0]), (2, [0.1, 0.2, 0.3]), (3, [0.1]), (4, []), (5, None),
            (6, [None, 0.1]), (7, [nan, 0.1]), (8, [inf, 0.1]), (None, [0.3, 0.3]), (9, [-0.1, 0.9])]
    sound = [r for r in rows if r[0] is None or r[0] in (1, 9)]
    got, centres = ct.cluster(frame(spark, rows), k=3, rounds=2, scale=64, dims=2)
    want, plain = brute(sound, 3, 2, 64)
    assert centres.tolist() == plain and by_row(got, "vec_id", "cluster", "distance") == want
    few, centres = ct.cluster(frame(spark, rows[:1]), k=3, dims=2)
    assert [(r.cluster, r.distance) for r in few.collect()] == [(0, 0)] and len(centres) == 1
    none = ct.with_totals(*ct.cluster(frame(spark, rows).where("false"), dims=2))
    assert none.count() == 0 and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    with pytest.raises(Exception, match="too large"):
        ct.cluster(frame(spark, [(1, [1e30, 0.0])]), dims=2)


def test_query(spark):
    from marginflow.llm.queries import op13_centroids

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    want, _ = brute(rows, 16, 3, 64)
    assert by_row(op13_centroids(spark, "/root/testdata/sf0.01"), "vec_id", "cluster", "distance") == want
