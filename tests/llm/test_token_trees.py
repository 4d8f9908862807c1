"""Stored trees after edits against fresh counts."""

import base64
import random
import subprocess
import sys
import textwrap

import public_tokenizers
import tiktoken

from tillroll.llm.token_trees import EDITS, apply_edits, open_trees, store_trees

from tests.llm.edge_rows import documents, empty, rows

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoder():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def random_edits(rng, texts, n):
    bits = ["a", "bc ", " ", "\n", "'s", "é", "日本", "123", "!", " word" * 80]
    return [(i, k, a, a + rng.choice([0, 1, 7, 60]), "".join(rng.choices(bits, k=rng.randrange(4))))
            for i, t in texts for k in range(n) for a in [rng.randint(0, len(t or ""))]]


def edited(text, edits):
    for _, _, a, b, new in sorted(edits, key=lambda e: e[1]):
        a = min(max(0, a), len(text))
        text = text[:a] + (new or "") + text[min(max(a, b), len(text)):]
    return text


def test_edits_of_a_later_application_equal_fresh_counts(spark, tmp_path):
    encode, rng = encoder(), random.Random(12)
    path = str(tmp_path / "trees")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    stored = store_trees(docs, RANKS, public_tokenizers.PATTERN, path, 4)
    assert {r.doc_id: r.n_tokens for r in stored.collect()} == {i: len(encode(t)) for i, t in texts}
    edits = random_edits(rng, texts[::3], 3)
    # Another application: it knows only the folder and the edits.
    spark.createDataFrame(edits, EDITS).write.parquet(str(tmp_path / "edits"))
    code = f"""
        import public_tokenizers
        from tillroll.session import build_session
        from tillroll.llm.token_trees import apply_edits, open_trees
        spark = build_session("local[2]", shuffle_partitions=4, extra_conf={{"spark.sql.warehouse.dir": "{tmp_path}/warehouse"}})
        out = apply_edits(open_trees(spark, "{path}", 4), spark.read.parquet("{tmp_path}/edits"),
                          public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, touched_only=True)
        out.write.parquet("{tmp_path}/out")
    """
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], check=True, capture_output=True, timeout=240)
    got = {r.doc_id: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert set(got) == {i for i, _ in texts[::3]}
    for i, t in texts[::3]:
        want = edited(t, [e for e in edits if e[0] == i])
        assert got[i].text == want and got[i].n_tokens == len(encode(want)) and got[i].first_tokens == len(encode(t))
    again = sum(sum(r.reencoded) for r in got.values())
    assert again < 0.5 * sum(r.n_pretokens for r in got.values())
    # The updated rows take the place of the old ones, and are edited once more.
    trees = open_trees(spark, path, 4)
    now = trees.join(spark.read.parquet(str(tmp_path / "out")).select("doc_id"), "doc_id", "left_anti").unionByName(
        spark.read.parquet(str(tmp_path / "out")).select(trees.columns))
    more = random_edits(rng, texts[::2], 1)
    for r in apply_edits(now, spark.createDataFrame(more, EDITS), RANKS, public_tokenizers.PATTERN).collect():
        want = edited(edited(dict(texts)[r.doc_id], [e for e in edits if e[0] == r.doc_id]), [e for e in more if e[0] == r.doc_id])
        assert r.text == want and r.n_tokens == len(encode(want))


def test_texts_are_not_shuffled(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    trees = store_trees(docs, RANKS, public_tokenizers.PATTERN, str(tmp_path / "t"), 8)
    edits = docs.selectExpr("doc_id", "1 as seq", "0L as start", "1L as end", "'x' as replacement")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = apply_edits(trees, edits, RANKS, public_tokenizers.PATTERN)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1


def test_edge_rows(spark, tmp_path):
    encode = encoder()
    trees = store_trees(documents(spark), RANKS, public_tokenizers.PATTERN, str(tmp_path / "t"), 3)
    edits = [(1, 1, 0, 5, "new"), (2, 2, 9, 3, "b"), (2, 1, -4, 0, "a"), (6, 1, 0, 3, None), (7, 1, 100_000, 100_004, "LONG"),
             (None, 1, 0, 0, "x"), (999, 1, 0, 0, "x"), (8, 1, 2, 10 ** 9, "")]
    got = sorted(((r.doc_id, r.text, r.n_tokens, len(r.after)) for r in apply_edits(
        trees, spark.createDataFrame(edits, EDITS), RANKS, public_tokenizers.PATTERN).collect()), key=str)
    want = []
    for r in rows():
        mine = [e for e in edits if e[0] == r[0] and r[0] is not None]
        text = edited(r[1] or "", mine)
        want.append((r[0], text, len(encode(text)), len(mine)))
    assert got == sorted(want, key=str)
    none = store_trees(empty(spark), RANKS, public_tokenizers.PATTERN, str(tmp_path / "e"), 3)
    assert apply_edits(none, spark.createDataFrame(edits, EDITS), RANKS, public_tokenizers.PATTERN).collect() == []
    assert apply_edits(trees, spark.createDataFrame([], EDITS), RANKS, public_tokenizers.PATTERN).count() == len(rows())
