"""Search against sorting all scores."""

import random

import numpy as np

from tillroll.llm.top_k import MOST, NONE, BallTree, top_k, whole_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, shard int, payload string, score long"


def brute(rows, k=5):
    good = [(i, [int(np.floor(256.0 * float(np.float32(x)))) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    queries = {}
    for i, v in good:
        if i % 50 == 0:
            queries[i] = min(queries.get(i, v), v)
    for i, q in queries.items():
        scored = sorted((-max(-MOST, min(MOST, sum(a * b for a, b in zip(q, v)))), j) for j, v in good if j != i and len(v) == len(q))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows):
    df = spark.createDataFrame([(i, v and [None if x is None else float(x) for x in v], 1, 2, "p", 3) for i, v in rows],
                               SCHEMA)
    vectors = whole_vectors(df, "vec_id", "embedding")
    return sorted(map(tuple, top_k(vectors, vectors.filter("vec_id % 50 = 0"), 5).collect()))


def test_random_ties_and_bad_vectors(spark):
    rng = random.Random(6)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(4)]) for i in range(400)]
    rows += [(400, [float("nan"), 1, 1, 1]), (450, None), (500, [None, 1.0, 1.0, 1.0]), (550, []), (None, [1.0] * 4),
             (600, [float("inf")] * 4), (650, [1.0, 2.0]), (651, [2.0, 2.0]), (700, [0.25] * 3), (100, [9.0] * 4), (7, [1.0] * 4)]
    assert run(spark, rows) == brute(rows)


def test_no_vectors(spark):
    assert run(spark, []) == []
    assert run(spark, [(50, [1.0])]) == []


def test_bounds_leave_out_nodes_and_lose_nothing():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 16)) * 2000
    rows = np.floor(np.repeat(centres, 200, axis=0) + rng.normal(size=(4000, 16)) * 20)
    ids = np.arange(4000)
    tree = BallTree(ids, rows)
    again = BallTree.unpacked(tree.packed())
    queries = rows[::50]
    own = ids[::50]
    found, scores = again.search(own, queries, 5, np.full(len(own), NONE))
    every = queries @ rows.T
    every[np.arange(len(own)), own] = -np.inf
    for r in range(len(own)):
        want = np.lexsort((ids, -every[r]))[:5]
        assert found[r].tolist() == want.tolist()
    floors = scores[:, -1]
    more, _ = again.search(own, queries, 5, floors)
    assert (more == found).all()


def test_large_finite_components(spark):
    rng = random.Random(9)
    rows = [(i, [rng.choice([1.0, -1.0]) * rng.choice([0.5, 3e5, 2.0 ** 24 + 2, 1e9]) for _ in range(3)]) for i in range(120)]
    rows += [(150, [1e30, 1.0, 0.0]), (200, [-1e30, 1e30, 1.0]), (250, [3e38, 3e38, -3e38]), (7, [3.4e38, 0.0, 0.0])]
    assert run(spark, rows) == brute(rows)


def test_a_task_carries_the_best_scores_from_tree_to_tree(spark, monkeypatch):
    from tillroll.llm import top_k as T
    monkeypatch.setattr(T, "TREE_ROWS", 16)
    monkeypatch.setattr(T, "LEAF_ROWS", 4)
    monkeypatch.setattr(T, "BLOCK_ROWS", 3)
    monkeypatch.setattr(T, "BLOCKS_HELD", 2)
    rng = random.Random(10)
    rows = [(i, [rng.gauss(0, 1) for _ in range(5)]) for i in range(500)]
    assert run(spark, rows) == brute(rows)
