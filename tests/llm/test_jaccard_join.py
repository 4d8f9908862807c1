"""The join against all pairs by brute force."""

import itertools
import os
import random
import re
import tracemalloc

import numpy as np

from tillroll.llm import jaccard_join as join
from tillroll.llm.jaccard_join import jaccard_join

from tests.llm.test_words import thue_morse

SCHEMA = "doc_id long, text string"


def brute(rows, width=5, least=75):
    sets = []
    for i, text in rows:
        words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        sets.append((i, {tuple(words[k:k + width]) for k in range(max(1, len(words) - width + 1))} if words else set()))
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    degree = [0] * len(sets)
    for a, b in itertools.combinations(range(len(sets)), 2):
        x, y = sets[a][1], sets[b][1]
        if x and y and 100 * len(x & y) >= least * len(x | y):
            degree[a] += 1
            degree[b] += 1
            parent[root(a)] = root(b)
    groups = {}
    for k in range(len(sets)):
        groups.setdefault(root(k), []).append(k)
    out = []
    for k, (i, s) in enumerate(sets):
        ids = [sets[m][0] for m in groups[root(k)] if sets[m][0] is not None]
        out.append((i, len(s), min(ids) if ids else None, degree[k]))
    return sorted(out, key=str)


def check(spark, rows):
    got = sorted(map(tuple, jaccard_join(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == brute(rows)


def test_random_near_copies(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    for _ in range(12):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 6, 40, 120]))]
        for _ in range(rng.choice([1, 2, 5])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                words[rng.randrange(len(words))] = rng.choice(vocab).upper()
            rows.append((i, " ".join(words)))
            i += 1
    rng.shuffle(rows)
    check(spark, rows)


def test_dense_family_over_several_blocks(spark):
    rng = random.Random(4)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(160):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2])):
            words[rng.randrange(60)] = f"x{rng.randrange(50)}"
        rows.append((1000 - i, " ".join(words)))
    check(spark, rows)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "ONE  two"), (6, "one two three"), (7, "a b c d e"),
            (7, "a b c d e"), (8, "x " * 50000), (9, "x " * 50000 + "y"), (None, "a b c d e"), (None, "lone words here")]
    check(spark, rows)


def test_empty_table_and_extra_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, hash long, digest string, u int")
    assert jaccard_join(empty).collect() == []
    df = spark.createDataFrame([(1, "a b", 5, "q", 1), (2, "a b", 5, "q", 1)],
                               "doc_id long, text string, hash long, digest string, u int")
    assert sorted(map(tuple, jaccard_join(df).collect())) == [(1, 1, 1, 1), (2, 1, 1, 1)]


def test_words_that_a_polynomial_takes_for_one(spark):
    check(spark, list(enumerate(thue_morse())))


def dense_block(seed, sets=96, size=1300):
    rng = np.random.default_rng(seed)
    base = np.random.default_rng(9).integers(1, 1 << 63, size).astype(np.uint64)
    members = []
    for _ in range(sets):
        hashes, changed = base.copy(), rng.choice(size, rng.choice([2, 150]), replace=False)
        hashes[changed] = rng.integers(1, 1 << 63, len(changed))
        members.append({"digest": int(rng.integers(1, 1 << 62)), "size": size, "alone": 0,
                        "prefix": size - join.Threshold().needed(size) + 1, "copies": 1, "shingles": hashes.tobytes()})
    return join._Block(members)


def test_verification_of_dense_blocks_takes_little_memory():
    a, b = dense_block(1), dense_block(2)
    tracemalloc.start()
    linked = join.links_between(a, b, join.Threshold(), False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    for i, j in itertools.product(range(0, 96, 7), range(0, 96, 5)):
        x, y = set(a.hash[a.owner == i].tolist()), set(b.hash[b.owner == j].tolist())
        assert linked[i, j] == (100 * len(x & y) >= 75 * len(x | y) and bool(
            set(a.hash[a.owner == i][:a.prefix[i]].tolist()) & set(b.hash[b.owner == j][:b.prefix[j]].tolist())))
    assert peak < 64 << 20


def test_verification_gets_pairs_of_blocks_in_bounded_batches(spark, monkeypatch, tmp_path):
    seen, verify = str(tmp_path / "batches"), join._verify

    def noting(threshold):
        run = verify(threshold)

        def noted(batches):
            def each():
                for batch in batches:
                    with open(f"{seen}-{os.getpid()}", "a") as out:
                        out.write(f"{batch.num_rows} {batch.nbytes}\n")
                    yield batch
            yield from run(each())
        return noted
    monkeypatch.setattr(join, "_verify", noting)
    monkeypatch.setattr(join, "PAIR_BYTES", 1 << 15, raising=False)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    check(spark, [(i, " ".join(f"x{i}" if k == i % 60 else f"b{k}" for k in range(60))) for i in range(300)])
    batches = [tuple(map(int, line.split())) for f in tmp_path.iterdir() for line in f.read_text().splitlines()]
    assert sum(n for n, _ in batches) >= 10                      # pairs of blocks
    assert max(n for n, _ in batches) <= 2
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
