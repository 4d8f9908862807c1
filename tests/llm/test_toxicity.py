"""Neighbours against all cosines, and held-out accuracy."""

import numpy as np
import pyarrow as pa

from tillroll.llm.queries import QUERIES
from tillroll.llm.toxicity import Neighbours, learn, nearest, score_toxicity

from tests.llm.edge_rows import documents, empty

SF = "/root/testdata/sf0.1"


def test_index_finds_the_exact_neighbours(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").selectExpr("doc_id", "toxic as label")
    model = learn(docs, labels, Neighbours(per_class=300, k=7))
    assert len(model.vocabulary) > 20 and len(model.blocks) > 5
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = model.rows(pa.array([texts[i] for i in model.ids.tolist()]))
    some = list(texts)[:400]
    queries = model.rows(pa.array([texts[i] for i in some]))
    sims, spots = nearest(model, queries, np.array(some))
    every = np.round(queries @ rows.T, 9)
    for q, i in enumerate(some):
        every[q, model.ids == i] = 0
        order = [p for p in np.lexsort((model.ids, -every[q])) if every[q, p] > 0][:7]
        assert np.allclose(sims[q, :len(order)], every[q, order], atol=2e-9)
        kept = spots[q][spots[q] >= 0]
        assert len(kept) == len(order)
        clear = [k for k in range(len(order)) if np.sum(np.abs(every[q] - every[q, order[k]]) < 3e-9) == 1]
        assert [kept[k] for k in clear] == [order[k] for k in clear]


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    lang = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op9_toxicity"](spark, SF).filter("held_out").join(labels, "doc_id").join(lang, "doc_id").collect()
    assert len(rows) > 500 and np.mean([r.predicted == r.toxic for r in rows]) > 0.96
    assert all(r.doc_id not in r.neighbours for r in rows)
    toxic, clean = [r for r in rows if r.toxic], [r for r in rows if not r.toxic]
    assert np.mean([r.predicted for r in toxic]) >= 0.9 and np.mean([r.predicted for r in clean]) <= 0.01
    for one in ("en", "de", "fr", "es"):
        assert np.mean([r.predicted for r in toxic if r.lang == one]) >= 0.8, one
    # Scores are shares of toxic rows: by tenths of the score, expected and found numbers agree.
    score, label = np.array([r.score for r in rows]), np.array([r.toxic for r in rows])
    for low, high in ((0, 0.1), (0.1, 0.5), (0.5, 0.9), (0.9, 1.01)):
        mine = (score >= low) & (score < high)
        assert abs(score[mine].sum() - label[mine].sum()) <= 3 + 3 * np.sqrt(score[mine] @ (1 - score[mine]))


def test_edge_rows(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(1, 0), (5, 0), (6, 0), (6, 1), (12, 1), (None, 1), (7, None), (77, 1), (8, 2), (13, -1)],
                                   "doc_id long, label int")
    got = score_toxicity(docs, learn(docs, labels, Neighbours(min_examples=1, min_chi2=0.1)), keep=("label",))
    assert got.columns == ["doc_id", "text", "label", "score", "neighbours", "similarities", "predicted"]
    model = learn(docs, labels)
    rows = score_toxicity(docs, model).collect()
    assert len(rows) == 18 and all(0 <= r.score <= 1 for r in rows)
    alone = score_toxicity(docs, learn(docs, labels.filter("label = 0"))).collect()
    assert {r.score for r in alone} == {0.0}
    assert {r.score for r in score_toxicity(docs, learn(docs, labels.limit(0))).collect()} == {0.0}
    assert score_toxicity(empty(spark), learn(empty(spark), labels)).collect() == []


def test_copy_of_a_labelled_row_is_found(spark):
    """Copies hold no term that tells the labels apart; the words of each toxic row are its own."""
    toxic = [(i, f"alpha{i} beta{i} gamma{i} delta{i}") for i in range(40)]
    clean = [(100 + i, f"some common prose about topic{i % 9}") for i in range(60)]
    copies = [(1000 + i, text) for i, text in toxic]
    docs = spark.createDataFrame(toxic + clean + copies, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i, _ in toxic] + [(i, 0) for i, _ in clean], "doc_id long, label int")
    rows = {r.doc_id: r for r in score_toxicity(docs, learn(docs, labels)).collect()}
    for i, _ in toxic:
        copy = rows[1000 + i]
        assert copy.neighbours[0] == i and abs(copy.similarities[0] - 1) < 1e-8 and copy.predicted == 1


def test_norm_holds_terms_that_no_example_has(spark):
    docs = spark.createDataFrame([(1, "red"), (2, "blue"), (3, "red green")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, label int")
    row = score_toxicity(docs, learn(docs, labels)).filter("doc_id = 3").first()
    red, green = np.log(4 / 3) + 1, np.log(4 / 2) + 1
    # "green" is one word and its first 4 bytes, both in one document
    assert row.neighbours == [1] and abs(row.similarities[0] - red / np.sqrt(red ** 2 + 2 * green ** 2)) < 1e-8


def test_scale_against_the_best_of_all_step_functions():
    """Isotonic regression has a closed form: the largest of all means from below of the least means to above."""
    from tillroll.llm.toxicity import isotonic
    rng = np.random.default_rng(4)
    x, label, weight = np.round(rng.random(60), 1), (rng.random(60) < 0.4) * 1.0, rng.random(60) + 0.5
    at, fit = isotonic(x, label, weight)
    values = np.unique(x)
    mean = lambda a, b: np.average(label[(x >= a) & (x <= b)], weights=weight[(x >= a) & (x <= b)])
    for v in values:
        want = max(min(mean(a, b) for b in values if b >= v) for a in values if a <= v)
        assert abs(np.interp(v, at, fit) - want) < 1e-12


def test_terms_votes_and_scores_against_plain_python(spark):
    """tf-idf, cosines and votes of a small corpus, worked out with dictionaries."""
    from collections import Counter
    rng = np.random.default_rng(6)
    words = [f"w{k}" for k in range(30)]
    texts = {i: " ".join(rng.choice(words, 8)) + (" bad" if i % 4 == 0 and i % 3 else "") + (" 0x" if i % 9 == 0 else "") for i in range(120)}
    label = {i: int(i % 4 == 0) for i in range(100)}
    rule = Neighbours(k=9, min_chi2=3, min_ratio=2, min_examples=2)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    model = learn(docs, spark.createDataFrame(list(label.items()), "doc_id long, label int"), rule)
    got = {r.doc_id: r for r in score_toxicity(docs, model).collect()}
    count = {i: Counter(t.split()) for i, t in texts.items()}                 # no word is longer than a stem
    df = Counter(w for c in count.values() for w in c)
    idf = {w: np.log(121 / (n + 1)) + 1 for w, n in df.items()}
    row = {i: {w: np.log1p(n) * idf[w] for w, n in c.items()} for i, c in count.items()}
    unit = lambda r: {w: v / np.sqrt(sum(x * x for x in r.values())) for w, v in r.items()} if r else {}
    cos = lambda a, b: sum(v * b.get(w, 0) for w, v in a.items())
    row = {i: unit(r) for i, r in row.items()}
    telling = set()
    for w in df:
        a, b = sum(w in row[i] for i in label if label[i]), sum(w in row[i] for i in label if not label[i])
        n1, n0 = 25, 75
        ratio = (a + 0.5) / (n1 + 1) / ((b + 0.5) / (n0 + 1))
        if a + b >= 2 and max(ratio, 1 / ratio) >= 2 and (n1 + n0) * (a * (n0 - b) - b * (n1 - a)) ** 2 / (
                n1 * n0 * (a + b) * (n1 + n0 - a - b)) >= 3:
            telling.add(w)
    told = {i: unit({w: v for w, v in r.items() if w in telling}) for i, r in row.items()}

    def vote(i):
        near = sorted(((round(cos(row[i], row[j]), 9), j) for j in label if j != i), key=lambda x: (-x[0], x[1]))
        near = [x for x in near if x[0] > 0][:9]
        top, up, down = near[0][0] if near else 1, 0.5 * 0.25, 0.5
        for s, j in near:
            w = (s / top) ** 2 * (1.001 - min(top, 1)) / (1.001 - min(s, 1)) * (
                cos(told[i], told[j]) if told[i] or told[j] else 1)
            up, down = up + w * label[j], down + w
        return up / down, near
    assert "bad" in telling
    for i in texts:
        score, near = vote(i)
        assert abs(np.interp(score, *model.scale) - got[i].score) < 1e-6, i
        assert np.allclose(got[i].similarities, [s for s, _ in near], atol=1e-8)


def _built(tmp_path, n=300, size=6000, each=700):
    """A stored model of ``n`` examples with ``each`` terms out of ``size``, and the most memory that making it took."""
    import tracemalloc

    from tillroll.llm.toxicity import Model, _build
    rng = np.random.default_rng(3)
    ids, toxic, vote = np.arange(n) * 7, (np.arange(n) % 3 == 0) * 1.0, np.ones(n)
    vocabulary = np.sort(rng.integers(1, 1 << 63, size, dtype=np.uint64))
    model = Model(Neighbours(), vocabulary, f"file://{tmp_path}", 1, 1000, np.zeros(0, np.int64), np.zeros(0), np.zeros(0), 0.3, 0.3)
    batches = [pa.RecordBatch.from_arrays([pa.array(np.full(each, i)), pa.array(rng.choice(vocabulary, each, False).view(np.int64)),
                                           pa.array(rng.integers(1, 5, each))], ["doc_id", "term", "n"]) for i in rng.permutation(ids)]
    tracemalloc.start()
    try:
        list(_build(model, ids, toxic, vote, np.full(size, 9))(iter(batches)))
        return model, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_making_the_model_takes_little_memory_an_entry(tmp_path):
    assert _built(tmp_path)[1] < 130 * 300 * 700                 # bytes


def test_workers_map_the_stored_arrays(tmp_path):
    import mmap

    from tillroll.llm.toxicity import MAPPED, StoredModel
    model, _ = _built(tmp_path)
    stored = StoredModel(model.rule, model.folder).load()
    for name in MAPPED:
        array, bases = getattr(stored, name), []
        assert np.array_equal(array, getattr(model, name)), name
        while array is not None:
            bases.append(type(array))
            array = getattr(array, "base", None)
        assert mmap.mmap in bases, name
    assert np.array_equal(stored.ids, model.ids) and np.array_equal(stored.scale, model.scale)
