"""Counts after edits against whole recounts."""

import base64
import random

import public_tokenizers
import pytest
import tiktoken

from tillroll.llm.token_counts import PreTokenCounter, TokenTree, count_with_edits

from tests.llm.edge_rows import documents, empty, rows

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encode():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def test_random_edits(encode):
    with open(RANKS, "rb") as f:
        counter = PreTokenCounter(f.read(), public_tokenizers.PATTERN)
    rng = random.Random(5)
    bits = ["a", "bc", " ", "  ", "\n", "'", "'s", "'re", "r", "e", "1", "23", "!", "é", "日", "\t", "Don't", " x "]
    for _ in range(150):
        text = "".join(rng.choice(bits) for _ in range(rng.choice([0, 3, 40, 700])))
        parts = counter.pattern.findall(text)
        tree = TokenTree(list(map(len, parts)), counter.counts(parts))
        for _ in range(6):
            a = rng.randint(0, len(text))
            b = min(len(text), a + rng.choice([0, 0, 1, 2, 50]))
            text, n = tree.edit(text, a, b, "".join(rng.choice(bits) for _ in range(rng.choice([0, 1, 3, 400]))), counter)
            assert tree.total == len(encode(text))
            assert tree.chars[1] == len(text)
            assert [x for s in tree.lengths for x in s] == list(map(len, counter.pattern.findall(text)))


def test_an_edit_in_a_long_text_encodes_little(encode):
    with open(RANKS, "rb") as f:
        counter = PreTokenCounter(f.read(), public_tokenizers.PATTERN)
    text = "some words and others " * 5000
    parts = counter.pattern.findall(text)
    tree = TokenTree(list(map(len, parts)), counter.counts(parts))
    text, n = tree.edit(text, 50000, 50003, "new", counter)
    assert n < 8 and tree.total == len(encode(text))


def test_edge_rows(spark, encode):
    edits = [lambda t: (len(t) // 2, len(t) // 2 + 20, t[:20]), lambda t: (0, 0, "New: ")]
    got = sorted(((r.doc_id, r.n_tokens, *r.after) for r in
                  count_with_edits(documents(spark), RANKS, public_tokenizers.PATTERN, edits).collect()), key=str)
    want = []
    for r in rows():
        t = r[1] or ""
        u = t[:len(t) // 2] + t[:20] + t[len(t) // 2 + 20:]
        want.append((r[0], len(encode(t)), len(encode(u)), len(encode("New: " + u))))
    assert got == sorted(want, key=str)
    assert count_with_edits(empty(spark), RANKS, public_tokenizers.PATTERN, edits).collect() == []


def test_patterns_that_look_far_ahead():
    """The new line joins all white space before it to one pre-token, far behind the edit's context."""
    pattern = r"\s*[\r\n]+|\s+|\S+"
    with open(RANKS, "rb") as f:
        counter = PreTokenCounter(f.read(), pattern)
    text = "\n" + " " * 10 + "x"
    parts = counter.pattern.findall(text)
    tree = TokenTree(list(map(len, parts)), counter.counts(parts))
    text, n = tree.edit(text, 11, 12, "\n", counter)
    fresh = counter.pattern.findall(text)
    assert [x for s in tree.lengths for x in s] == list(map(len, fresh)) == [12]
    assert tree.total == sum(counter.counts(fresh))


def test_registered_pattern_is_bounded():
    with open(RANKS, "rb") as f:
        assert PreTokenCounter(f.read(), public_tokenizers.PATTERN).bounded
