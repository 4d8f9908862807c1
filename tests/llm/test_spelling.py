"""Near words, forms and roots against plain edits."""

import random
import re
import zlib
from collections import Counter

from tillroll.llm import spelling
from tillroll.llm.spelling import ALPHABET, spelling_variants

from tests.llm.edge_rows import SCHEMA, documents, empty, rows

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, ratio=5):
    count = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 6 and c >= 5}
    letters = [chr(c) for c in ALPHABET]
    near = {}
    for w in n:
        edits = {w[:k] + w[k + 1:] for k in range(len(w))}
        if len(w) < 1000:
            edits |= {w[:k] + c + w[k + 1:] for k in range(len(w)) for c in letters}
            edits |= {w[:k] + c + w[k:] for k in range(len(w) + 1) for c in letters}
        near[w] = {e for e in edits if e in n and e != w}
    for w in n:
        for e in near[w]:
            near[e].add(w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda e: (-n[e], e), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def table(df, **options):
    return sorted(map(tuple, spelling_variants(df, **options).collect()))


def corpus():
    rng = random.Random(11)
    letters = [chr(c) for c in ALPHABET]
    base = ["".join(rng.choices(letters[:8], k=rng.randrange(6, 10))) for _ in range(40)] + ["aaaaaa", "aaaaaaa", "aaaaaaaa"]
    texts = []
    for k in range(900):
        words = []
        for _ in range(20):
            w = list(base[min(int(rng.expovariate(0.15)), len(base) - 1)])
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                kind, at = rng.randrange(3), rng.randrange(len(w))
                w[at:at + (kind != 0)] = [] if kind == 1 else [rng.choice(letters[:6] + letters[-2:])]
            words.append("".join(w).upper() if rng.random() < 0.1 else "".join(w))
        texts.append((k, "-".join(words)))
    return texts


def test_random_variants_in_one_pass_and_in_several(spark, monkeypatch):
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    want = brute(docs)
    assert any(r[1] and r[2] != r[1] for r in want) and max(r[4] for r in want) > 5
    assert table(df) == want
    # One bitmap a pass, and a filter that lets everything through, change nothing.
    monkeypatch.setattr(spelling, "EDITS_AT_ONCE", 3000)
    shards = spelling.Shards.__init__
    monkeypatch.setattr(spelling.Shards, "__init__", lambda self, counts: shards(self, counts, 512))
    assert table(df, filter_bytes=4096) == want
    monkeypatch.setattr(spelling.Shards, "__init__", lambda self, counts: shards(self, counts, 1))
    assert table(df) == want


def test_edge_rows(spark):
    several = [(r[0], r[1]) for r in rows()] * 6 + [(i, "y" * 300 + " " + "y" * 299 + " longest longes été×÷éé") for i in range(9)]
    assert table(spark.createDataFrame(several, "doc_id long, text string")) == brute(several)
    extra = documents(spark)
    for _ in range(5):
        extra = extra.unionByName(documents(spark))
    assert table(extra.withColumn("word", extra.draw).withColumn("key", extra.draw)) == brute([(r[0], r[1]) for r in rows()] * 6)
    assert table(empty(spark)) == [] and SCHEMA
    assert table(documents(spark).filter("doc_id < 4")) == []
