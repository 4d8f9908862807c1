"""Scores against a plain dictionary model."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from tillroll.llm.frames import distinct, sort_order
from tillroll.llm.lm_score import Arrays, _coded, _places, _prints, _store, print_keys, score_texts, search, train

from tests.llm.edge_rows import documents, empty, rows
from tests.llm.test_words import plain


def discounts(counts):
    n = Counter(min(c, 5) for c in counts)
    n1, n2, n3, n4 = (n[k] for k in (1, 2, 3, 4))
    if not (n1 and n2 and n3):
        return [0, 0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    return [0, *(min(max(d, 0), k) for k, d in ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3)))]


def brute(training, texts):
    words, pairs, begun = Counter(), Counter(), 0
    for t in training:
        seq = [*plain(t), "</end>"]
        words.update(seq)
        pairs.update(zip(["<start>", *seq[:-1]], seq))
        begun += 1
    before, after = defaultdict(set), defaultdict(list)
    for (v, w), c in pairs.items():
        before[w].add(v)
        after[v].append(c)
    n, types = sum(words.values()), len(words)
    d2, d1 = discounts(pairs.values()), discounts([len(x) for x in before.values()])
    rest = sum(d1[min(len(x), 3)] for x in before.values()) / len(pairs) if pairs else 1.0

    def lower(w):
        k = len(before.get(w, ()))
        return ((k - d1[min(k, 3)]) / len(pairs) if pairs else 0) + rest / (types + 1)

    def prob(v, w):
        total = begun if v == "<start>" else words[v]
        if not total:
            return lower(w)
        c = pairs[v, w]
        return (c - d2[min(c, 3)]) / total + sum(d2[min(x, 3)] for x in after[v]) / total * lower(w)
    out = []
    for t in texts:
        seq = [*plain(t), "</end>"]
        out.append((len(seq), sum(words[w] > 0 for w in seq), n,
                    sum(math.log10((words[w] + 1) / (n + types + 1)) for w in seq),
                    sum(math.log10(prob(v, w)) for v, w in zip(["<start>", *seq[:-1]], seq))))
    vocab = list(words) + ["<unknown>"]
    for v in ["<start>", *list(words)[:20]]:
        if v != "</end>" and pairs:
            assert sum(prob(v, w) for w in vocab) == pytest.approx(1)
    return out


def test_matches_plain_model(spark):
    docs = documents(spark).filter("doc_id is not null")
    held = docs.filter("doc_id % 3 = 0")
    training = docs.filter("doc_id % 3 <> 0")
    got = sorted(map(tuple, score_texts(docs, train(training, order=2)).select(
        "doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()))
    source = sorted(((r[0], r[1]) for r in rows() if r[0] is not None), key=lambda r: r[0])
    expected = brute([t for i, t in source if i % 3], [t for _, t in source])
    assert held.count() and [g[:4] for g in got] == [(i, *e[:3]) for (i, _), e in zip(source, expected)]
    for g, e in zip(got, expected):
        assert g[4] == pytest.approx(e[3], rel=1e-9) and g[5] == pytest.approx(e[4], rel=1e-9)


def test_beats_the_base_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    scored = score_texts(docs.filter("doc_id % 7 = 2"), train(docs.filter("doc_id % 7 <> 2")))
    assert scored.selectExpr("sum(score) > sum(base_score)").first()[0]


def test_empty_tables(spark):
    none = train(empty(spark), order=2)
    assert score_texts(empty(spark), none).collect() == []
    row = score_texts(documents(spark).filter("doc_id = 5"), none).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score, row.score) == (8, 0, 0, 0.0, 0.0)


def higher(training, texts, order):
    """Scores by a plain model of any order: counts of order k are the different grams above that end in them."""
    def split(t):
        seq = ["<start>"] * (order - 1) + [*plain(t), "</end>"]
        return [tuple(seq[i - order + 1:i + 1]) for i in range(order - 1, len(seq))]
    counts = {order: Counter(g for t in training for g in split(t))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    d = {k: discounts([x for g, x in c.items() if g != ("<start>",)]) for k, c in counts.items()}
    after = {k: defaultdict(list) for k in counts}
    for k, c in counts.items():
        for g, x in c.items():
            after[k][g[:-1]].append(x)

    def prob(g):
        k = len(g)
        if k == 0:
            return 1 / (len(counts[1]) + 1)
        had = after[k][g[:-1]]
        if not had:
            return prob(g[1:])
        x = counts[k][g]
        return (x - d[k][min(x, 3)] + sum(d[k][min(y, 3)] for y in had) * prob(g[1:])) / sum(had)
    for g in list(counts[order])[:10]:
        assert sum(prob((*g[:-1], w)) for w, in [*counts[1], ("<unknown>",)]) == pytest.approx(1)
    return [sum(math.log10(prob(g)) for g in split(t)) for t in texts]


@pytest.mark.parametrize("order", [2, 3, 4])
def test_orders_match_plain_model(spark, order):
    docs = documents(spark).filter("doc_id is not null")
    got = sorted(map(tuple, score_texts(docs, train(docs.filter("doc_id % 3 <> 0"), order=order)).select("doc_id", "score").collect()))
    source = sorted(((r[0], r[1]) for r in rows() if r[0] is not None), key=lambda r: r[0])
    expected = higher([t for i, t in source if i % 3], [t for _, t in source], order)
    assert [g[0] for g in got] == [i for i, _ in source]
    for g, e in zip(got, expected):
        assert g[1] == pytest.approx(e, rel=1e-9)


def test_order_three_uses_two_words_of_context(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(200)
    two, three = (score_texts(docs, train(docs, order=k)).selectExpr("sum(score)").first()[0] for k in (2, 3))
    assert three > two


def test_prints_find_what_is_stored_and_hardly_anything_else(tmp_path):
    """Values come back exactly, upper bits that agree included; of unseen hashes about one in a million is taken for a stored one."""
    rng = np.random.default_rng(3)
    stored = np.unique(rng.integers(0, 2 ** 64, 400_000, dtype=np.uint64))
    twins = stored[:1000] ^ np.uint64(1 << 24)                   # the same 32 upper bits, the next of the other 8
    stored = np.unique(np.concatenate([stored, twins]))
    columns = [rng.integers(0, n, len(stored)) for n in (3, 70_000, 2)]
    _store(f"file://{tmp_path}", "x-00005", *_prints(stored), *_coded(columns))
    arrays = Arrays(f"file://{tmp_path}")
    keys = print_keys(np.full(len(stored), 5), stored)
    assert all((got == want).all() for got, want in zip(arrays.find_prints("x", keys, 3), columns))
    _store(f"file://{tmp_path}", "y-00005", *_prints(stored), np.ones(len(stored), np.uint8))
    unseen = np.sort(rng.integers(0, 2 ** 64, 2_000_000, dtype=np.uint64))
    assert arrays.find_prints("y", print_keys(np.full(len(unseen), 5), unseen))[0].sum() <= 8
    assert arrays.find_prints("y", print_keys(np.full(len(unseen), 6), unseen))[0].sum() == 0


@pytest.mark.parametrize("top", [1, 5, 1 << 20, (1 << 64) - 1])
@pytest.mark.parametrize("n", [0, 1, 2, 1000, 70_001])
def test_orders_and_distinct_values_are_those_of_numpy(n, top):
    values = np.random.default_rng(n).integers(0, top, n, dtype=np.uint64, endpoint=True)
    values[n // 2:] = values[:n - n // 2]                        # repeats
    values[n // 3:n // 3 + 50] ^= np.uint64(1)                   # and values that differ in the last bit alone
    assert (sort_order(values) == np.argsort(values, kind="stable")).all()
    found, which = distinct(values)
    want, place = np.unique(values, return_inverse=True)
    assert (found == want).all() and (which == place).all()


@pytest.mark.parametrize("n", [1, 2, 31, 64, 5000, 200_000])
def test_places_lead_to_where_values_lie(n):
    rng = np.random.default_rng(n)
    for high in (1 << 32, 1 << 20):                              # evenly spread, as prints are, and all at one end
        values = np.sort(rng.integers(0, high, n, dtype=np.uint64)).astype(np.uint32)
        wanted = np.concatenate([values, rng.integers(0, 1 << 32, 3000, dtype=np.uint64).astype(np.uint32),
                                 np.array([0, (1 << 32) - 1], np.uint32)])
        assert (search(values, _places(values), wanted) == np.searchsorted(values, wanted)).all()
        assert len(_places(values)) <= max(2, n // 32 + 1)
