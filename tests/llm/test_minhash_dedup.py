"""Components against all pairs by brute force; the posterior against its integral."""

import random

import numpy as np
import pytest

from tillroll.llm import frames
from tillroll.llm import minhash_dedup as M
from tillroll.llm.minhash_dedup import minhash_dedup

from tests.llm.edge_rows import documents, empty, rows
from tests.llm.test_jaccard_join import brute
from tests.llm.test_words import thue_morse

SCHEMA = "doc_id long, text string"


def check(spark, rows):
    got = sorted(map(tuple, minhash_dedup(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()), key=str)
    assert got == sorted(((i, n, c, i == c) for i, n, c, _ in brute(rows, 3, 85)), key=str)


def near_copies(rng, base, n, edits, vocab):
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.choice(edits)):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        out.append(" ".join(words))
    return out


def test_random_near_copies(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(400)] + ["É", "ß日"]
    texts = []
    for _ in range(14):
        base = rng.choices(vocab, k=rng.choice([2, 3, 7, 60, 150]))
        texts += near_copies(rng, base, rng.choice([1, 2, 6]), [0, 0, 1, 2, 3], [w.upper() for w in vocab])
    rng.shuffle(texts)
    check(spark, list(enumerate(texts)))


@pytest.mark.parametrize("block, grid", [(48, 32), (7, 2)])
def test_dense_groups_over_several_blocks(spark, monkeypatch, block, grid):
    """Copies of copies: most pairs share a key, few links lead to the hub, components stay apart."""
    monkeypatch.setattr(M, "BLOCK", block)
    monkeypatch.setattr(frames, "GRID", grid)
    rng = random.Random(block)
    base = [f"b{i}" for i in range(120)]
    texts = near_copies(rng, base, 40, [0, 1, 2, 3, 4, 5], [f"x{k}" for k in range(300)])
    chain = list(base)
    for k in range(60):                          # each is near the one before, the ends are not near each other
        chain[2 * k] = f"c{k}"
        texts.append(" ".join(chain))
    check(spark, [(1000 - k, t) for k, t in enumerate(texts)])


def test_a_text_that_a_third_of_all_rows_hold(spark):
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(300)]
    base = rng.choices(vocab, k=90)
    texts = [" ".join(base)] * 200 + near_copies(rng, base, 100, [1], ["only", "here"]) + [
        " ".join(rng.choices(vocab, k=50)) for _ in range(200)]
    rng.shuffle(texts)
    check(spark, list(enumerate(texts)))


def test_edge_rows(spark):
    several = [(r[0], r[1]) for r in rows()] + [(20, thue_morse()[0]), (21, thue_morse()[1]), (None, "word"), (22, "a b"), (23, "A b")]
    got = sorted(map(tuple, minhash_dedup(spark.createDataFrame(several, SCHEMA)).collect()), key=str)
    assert got == sorted(((i, n, c, i == c) for i, n, c, _ in brute(several, 3, 85)), key=str)
    assert len(minhash_dedup(documents(spark)).collect()) == len(rows())
    assert minhash_dedup(empty(spark)).collect() == []


def test_posterior_bounds():
    at = (np.arange(200_000) + 0.5) / 200_000
    for n, m in M.least_matches(0.85):
        for matches, over in ((m, True), (m - 1, False)):
            density = at ** matches * (1 - at) ** (n - matches)
            assert (density[at >= 0.85].sum() / density.sum() >= M.MISS) == over


def test_minima_collide_as_often_as_sets_are_alike():
    rng = np.random.default_rng(2)
    every = rng.integers(0, 2 ** 64, 3000, dtype=np.uint64)
    for share in (0.3, 0.6, 0.85):
        same = np.mean([np.mean(np.equal(*M.minima(np.concatenate([rng.permutation(x) for x in sets]), np.array([0, 200, 400]))))
                        for sets in _alike(rng, every, share, 60)])
        assert abs(same - share) < 0.02


def _alike(rng, every, share, n):
    common = round(400 * share / (1 + share))
    for _ in range(n):
        mine = rng.choice(every, 400 - common, replace=False)
        yield mine[:200], np.concatenate([mine[:common], mine[200:]])


def test_blocks_and_hubs_meet_in_one_task_a_partition(spark, monkeypatch):
    """However small the pieces that Spark may cut from uneven joins: what two blocks hold is not joined to pairs of them."""
    rng = random.Random(23)
    texts = [t for k in range(12) for t in near_copies(
        rng, [f"b{k}x{i}" for i in range(120)], 30, [0, 1, 2, 3, 4, 5], [f"x{k}" for k in range(300)])]
    monkeypatch.setattr(M, "BLOCK", 7)
    written = {}

    def kept(df, name):
        written[name] = frames.write_scratch(df, name)
        return written[name]
    monkeypatch.setattr(M, "write_scratch", kept)
    conf = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        check(spark, [(k, t) for k, t in enumerate(texts)])
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert written["rest-links"].count()
    assert len(written["rest-links"].inputFiles()) <= 8


@pytest.mark.parametrize("parts", [2000, 3])
def test_a_hub_of_many_pairs_is_dealt_to_several_tasks(spark, monkeypatch, parts):
    monkeypatch.setattr(M, "PARTS", parts)
    pairs = [(u, v) for v, n in ((1, 60), (2, 25), (3, 1)) for u in range(100, 100 + n)]
    some = frames.write_scratch(spark.createDataFrame(pairs, "u long, v long"), "some")
    table = spark.createDataFrame([(k, f"value {k}") for k in [*range(1, 4), *range(100, 160)]], "digest long, value string")
    got = sorted(tuple(r) for r in M._against(some, table, "value").select("u", "v", "left", "right").collect())
    assert got == sorted((u, v, f"value {u}", f"value {v}") for u, v in pairs)
