"""Scores and ranks against a plain scorer, and the shared sums against plain sums."""

import math
import random
import re
from collections import Counter

import numpy as np

from tillroll.llm import lexical_rank
from tillroll.llm.lexical_rank import rank_documents, share

from tests.llm.edge_rows import documents, empty, rows

LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, k=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n, length = len(counts), sum(c[2] for c in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, m in counts:
            m = 25 + 75 * m * n // length
            scored.append((sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m))
                               for t in terms(text) if c[t]), i))
        best = sorted((s for s in scored if s[0] > 0), key=lambda s: (-s[0], s[1] is None, s[1] or 0))[:k]
        out += [(item, r, i, s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out, key=str)


def check(spark, docs, items, k=10):
    got = rank_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                         spark.createDataFrame(items, "item_id long, text string"), k)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, k)


def test_random_items_that_share_terms(spark, monkeypatch):
    rng = random.Random(5)
    vocab = [f"t{i}" for i in range(60)] + ["Éa", "日本", "x9"]
    phrases = [" ".join(rng.choices(vocab, k=6)) for _ in range(8)]
    docs = [(i, " ".join(rng.choices(vocab, k=rng.randrange(1, 80)) + rng.choices(phrases, k=rng.randrange(3)))) for i in range(120)]
    items = [(i, ", ".join(rng.choices(phrases, k=3) + rng.choices(vocab, k=4)).upper()) for i in range(30)]
    check(spark, docs, items)
    # Narrow accumulators, early cuts and several blocks of items change nothing.
    monkeypatch.setattr(lexical_rank, "ITEM_BYTES", 700)
    monkeypatch.setattr(lexical_rank, "MATRIX_BYTES", 1)
    monkeypatch.setattr(lexical_rank, "KEPT", 5)
    check(spark, docs, items, k=3)


def test_edge_rows(spark):
    docs = [(r[0], r[1]) for r in rows()]
    items = [(1, None), (2, ""), (3, "..."), (4, "one two one"), (4, "one two one"), (None, "long NBSP é日本😀"), (5, "absent"),
             (6, "one " * 5000), (7, docs[5][1])]
    check(spark, docs, items)
    asked = spark.createDataFrame([(1, "one", 3, 4)], "item_id long, text string, block int, term long")
    assert [r.item_id for r in rank_documents(documents(spark), asked).collect()] == [1, 1, 1]
    assert rank_documents(empty(spark), asked).collect() == []
    assert rank_documents(documents(spark), asked.limit(0)).collect() == []


def test_shared_sums_are_the_plain_sums():
    rng = np.random.default_rng(1)
    common = [rng.integers(0, 400, 12) for _ in range(5)]
    item, term = [], []
    for i in range(50):
        mine = np.concatenate([*(common[j] for j in rng.choice(5, 2)), rng.integers(0, 400, 5)])
        item += [i] * len(mine)
        term += mine.tolist()
    plan = share(np.array(item), np.array(term, np.uint64), 50, np.arange(50), np.ones(50, np.uint8))
    value = {t: int(rng.integers(1, 1000)) for t in term}
    node = [0] * plan.atoms
    for t, a in zip(plan.terms.tolist(), plan.atom):
        node[a] += value[t]
    for a, ta, b, tb in plan.pairs:
        node.append(node[a] * int(ta) + node[b] * int(tb))
    got = [sum(node[p] * int(n) for p, n in zip(plan.part[a:b], plan.times[a:b])) for a, b in zip(plan.first, plan.first[1:])]
    assert got == [sum(value[t] for i, t in zip(item, term) if i == k) for k in range(50)]
    # Fewer parts than distinct terms of the items: what is shared is added up once.
    assert len(plan.pairs) and plan.first[-1] + 2 * len(plan.pairs) < 0.7 * len({(i, t) for i, t in zip(item, term)})
