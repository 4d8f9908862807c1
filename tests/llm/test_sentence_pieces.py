"""Ids, decoded text and spans against the library."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from tillroll.llm.sentence_pieces import Normaliser, PieceCoder, decode_pieces, encode_pieces
from tillroll.llm.words import Words

from tests.llm.edge_rows import documents, empty, rows
from tests.llm.test_words import thue_morse

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_edge_rows(spark, library):
    got = decode_pieces(encode_pieces(documents(spark), MODEL), MODEL).collect()
    expected = sorted(((r[0], library.encode(r[1] or "", add_eos=True)) for r in rows()), key=str)
    assert sorted(((r.doc_id, r.ids) for r in got), key=str) == expected
    for r in got:
        assert r.decoded == library.decode(r.ids) and len(r.begins) == len(r.ends) == len(r.ids)


def test_spans_are_the_librarys(spark, library):
    texts = [r[1] for r in rows() if r[1] and len(r[1]) < 1000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for row in encode_pieces(docs, MODEL, add_eos=False, add_bos=False).collect():
        text = texts[row.doc_id]
        pieces = library.encode(text, return_type="proto").pieces
        raw = text.encode()
        for p, b, e in zip(pieces, row.begins, row.ends):
            assert library.is_byte(p.id) or (b, e) == (p.begin, p.end), (text, p)
        whole = [(b, e) for b, e in zip(row.begins, row.ends)]
        assert whole[0][0] == 0 and whole[-1][1] == len(raw)
        assert all(x[1] == y[0] for x, y in zip(whole, whole[1:]))


def test_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    once = {r.doc_id: r.decoded for r in encode_pieces(docs, MODEL, decoded=True).collect()}
    for r in decode_pieces(encode_pieces(docs, MODEL), MODEL).collect():
        assert r.decoded == once[r.doc_id]
        assert r.ids == library.encode(texts[r.doc_id], add_eos=True) and r.decoded == library.decode(r.ids)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf", "identity"])
@pytest.mark.parametrize("trim", [True, False])
def test_character_map_and_alignment(rule, trim):
    theirs = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True,
                                                   remove_extra_whitespaces=trim)
    ours = Normaliser(proto.NormalizerSpec.FromString(theirs.serialized_normalizer_spec())
                      if isinstance(theirs.serialized_normalizer_spec(), bytes) else
                      proto.ModelProto.FromString(theirs.serialized_model_proto()).normalizer_spec)
    for text in ["ＡＢＣ　①", "  lead  and   trail  ", "ﬁne ½ ㌔ é Ⅷ", "a\tb\nc​d", "", "   ", "日本語 ｶﾞ", "x"]:
        want, offsets = theirs.normalize(text, with_offsets=True)
        got, align = ours(text.encode())
        assert got.decode() == want, (rule, trim, text)
        starts, at = [], 0
        for ch in got.decode():
            starts.append(len(text.encode()[:align[at]].decode()))
            at += len(ch.encode())
        assert starts == list(offsets)[:len(starts)], (rule, trim, text)


def test_empty_table(spark):
    assert decode_pieces(encode_pieces(empty(spark), MODEL), MODEL).collect() == []


def test_flat_way_is_the_general_way(library):
    import random

    import numpy as np
    import pyarrow as pa

    from tillroll.llm.sentence_pieces import PieceCoder
    with open(MODEL, "rb") as f:
        it = PieceCoder(f.read())
    rng = random.Random(8)
    bits = ["a", "the", " ", "  ", "\n", "é", "日", "\U0001F600", "Word", "\t", "1", "...", "\x00"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.choice([0, 1, 5, 60]))) for _ in range(300)]
    ids, begins, ends, offsets = it.encode_flat(pa.array(texts))
    for k, (want, b, e) in enumerate(it.encode(texts)):
        part = slice(offsets[k], offsets[k + 1])
        assert ids[part].tolist() == want.tolist() == library.encode(texts[k])
        assert begins[part].tolist() == b.tolist() and ends[part].tolist() == e.tolist()
    assert it.encode_flat(pa.array(["a ▁ b"])) is None
    lists = [[], [2], [1, 264, 2], [0, 264], [264, 0, 2], [3 + 0xE3], [3 + 0xE3, 3 + 0x81, 264], [28705, 28705, 264], [13, 264]]
    flat = np.array([i for x in lists for i in x], np.int64)
    assert it.decode_flat(flat, np.cumsum([0, *map(len, lists)])) == [library.decode(x) for x in lists]


def test_words_of_one_hash_keep_their_own_ids(spark, library, monkeypatch):
    pair = list(thue_morse())
    texts = [" ".join(pair), pair[1], pair[0]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    for row in encode_pieces(docs, MODEL).collect():
        assert row.ids == library.encode(texts[row.doc_id], add_eos=True)
    # Even if all words had one hash: within a slice, and between slices.
    it = PieceCoder(open(MODEL, "rb").read())
    assert it.encode_flat(pa.array(["word"]))[0].tolist() == library.encode("word")
    monkeypatch.setattr(Words, "hashes", lambda self, lower=True: np.zeros(len(self.starts), np.uint64))
    assert it.encode_flat(pa.array(["one two"])) is None
    it.by_hash[0] = b" other", b""
    assert it.encode_flat(pa.array(["word"])) is None
