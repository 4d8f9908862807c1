"""Collision rates against generalised Jaccard similarity; edits against plain Python."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tillroll.llm.fingerprints import fingerprint_edits, fingerprint_texts, likeness, signatures

from tests.llm.edge_rows import documents, empty, rows
from tests.llm.test_words import plain


def similarity(a, b):
    x, y = Counter(plain(a)), Counter(plain(b))
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def test_collision_rate_is_generalised_jaccard():
    rng = random.Random(2)
    vocab = [f"v{i}" for i in range(200)]
    a = [" ".join(rng.choices(vocab[:n], k=300)) for n in (10, 50, 200, 200)]
    b = [" ".join(x.split()[:200] + rng.choices(vocab, k=100)) for x in a]
    sa, ha = signatures(pa.array(a), 4096)
    sb, hb = signatures(pa.array(b), 4096)
    got = likeness(sa, sb, ha, hb)
    want = [similarity(x, y) for x, y in zip(a, b)]
    assert np.abs(got - want).max() < 0.04


def test_edits_and_successors(spark):
    got = sorted(((r.doc_id, r.text, r.edited) for r in fingerprint_edits(documents(spark)).collect()), key=str)
    ordered = sorted(((r[0], r[1] or "") for r in rows()),
                     key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    want = []
    for k, (i, t) in enumerate(ordered):
        n = ordered[(k + 1) % len(ordered)][1]
        want.append((i, t, t[:len(t) - len(t) // 3] + n[:len(t) // 3]))
    assert got == sorted(want, key=str)


def test_likeness_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = {r.doc_id: r for r in fingerprint_edits(docs).collect()}
    plainly = {r.doc_id: r.fingerprint for r in fingerprint_texts(docs).collect()}
    ids = sorted(rows, reverse=True)
    errors = []
    for k, i in enumerate(ids):
        r, n = rows[i], rows[ids[(k + 1) % len(ids)]]
        assert r.fingerprint == plainly[i]
        same = sum(r.fingerprint[j:j + 4] == n.fingerprint[j:j + 4] for j in range(0, 256, 4)) / 64
        assert r.near_next == same
        errors.append(r.near_edited - similarity(r.text, r.edited))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.09


def test_one_row_and_no_row(spark):
    assert fingerprint_edits(empty(spark)).collect() == []
    one = fingerprint_edits(spark.createDataFrame([(5, "abcdef")], "doc_id long, text string")).collect()
    assert [(r.edited, r.near_next) for r in one] == [("abcdab", 1.0)]
    blank = fingerprint_edits(spark.createDataFrame([(None, None)], "doc_id long, text string")).collect()
    assert [(r.edited, r.fingerprint, r.near_next) for r in blank] == [("", "", pytest.approx(1.0))]
