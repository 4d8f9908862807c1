"""Each stage against a plain version on the predecessor's rows."""

from collections import Counter

import public_tokenizers
import sentencepiece

import corpus_pipeline as P
from tillroll.llm.frames import write_scratch
from tillroll.llm.queries import QUERIES
from tillroll.llm.secret_scan import scan_text

from tests.llm.edge_rows import documents, empty
from tests.llm.test_jaccard_join import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    stages = dict(P.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rejected = {r.doc_id for r in QUERIES["op9_toxicity"](spark, SF).filter("predicted = 1").collect()}
    one = write_scratch(stages["toxicity"](spark, docs, SF), "t")
    assert one.columns == docs.columns
    assert sorted(r.doc_id for r in one.collect()) == sorted(r.doc_id for r in docs.collect() if r.doc_id not in rejected)

    two = write_scratch(stages["near_duplicates"](spark, one, SF), "t")
    groups = brute([(r.doc_id, r.text) for r in one.collect()])
    assert sorted(r.doc_id for r in two.collect()) == sorted(g[0] for g in groups if g[0] == g[2])

    three = write_scratch(stages["secrets"](spark, two, SF), "t")
    texts = {r.doc_id: r.text for r in two.collect()}
    for r in three.collect():
        spans, out, at = scan_text(texts[r.doc_id]), "", 0
        for kind, a, b, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
            if a >= at:
                out += texts[r.doc_id][at:a] + f"[{kind}]"
            at = max(at, b)
        assert r.text == out + texts[r.doc_id][at:]

    four = write_scratch(stages["mix"](spark, three, SF), "t")
    from tillroll.llm.mixture import mix_sources
    want = Counter({r.doc_id: r.repeats for r in mix_sources(three).collect() if r.repeats})
    assert Counter(r.doc_id for r in four.collect()) == want and four.columns == docs.columns

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in four.collect()}
    five = stages["pieces"](spark, four, SF).collect()
    assert len(five) == four.count()
    assert all(r.ids == library.encode(texts[r.doc_id], add_eos=True) for r in five)


def test_run_is_the_stages_in_order(spark):
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "secrets", "mix", "pieces"]
    assert P.run(spark, SF).count() > 0


def test_edge_rows_and_empty_table(spark, tmp_path):
    documents(spark).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(5, 0), (12, 1)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (documents(spark), empty(spark)):
        for name, stage in P.STAGES:
            docs = write_scratch(stage(spark, docs, str(tmp_path)), "t")
        rows = docs.collect()
    assert rows == []
    kept = dict(P.STAGES)["near_duplicates"](spark, documents(spark), str(tmp_path))
    assert Counter(r.doc_id for r in kept.collect())[6] == 0 and kept.count() == 16


def test_near_duplicates_with_repeated_ids_and_clashing_names(spark):
    same, other = "one two three four five six seven eight", "quite another text with words of its own here"
    rows = [(5, "A " + same, 77, 88), (5, other, 77, 89), (1, other, 77, 90), (None, other, 77, 91), (None, "A " + same, 77, 92),
            (9, "A " + same, 77, 93), (7, None, 77, 94), (7, None, 77, 94), (None, "lone words of nobody", 77, 95)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, a, b, 3) for i, t, a, b in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, _copy int, _row int, number int")
    kept = dict(P.STAGES)["near_duplicates"](spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted((r._copy, r._row, r.number) for r in kept.collect()) == [(77, k, 3) for k in (88, 90, 94, 95)]
