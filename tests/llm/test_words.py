import random
import re

import numpy as np
import pyarrow as pa

from tillroll.llm.frames import delta, pack, undelta, unpack
from tillroll.llm.words import shingle_hashes, split_words

from tests.llm.edge_rows import rows

LOWER = {c: c + 32 for c in range(65, 91)}


def plain(text):
    return [w.translate(LOWER) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]


def test_words_and_shingles_match_plain_python():
    texts = [r[1] for r in rows()] + ["ab", "cd", "", None, "ef"]
    words = split_words(pa.array(texts, pa.string()))
    expected = [plain(t) for t in texts]
    assert words.counts.tolist() == list(map(len, expected))
    flat = [w for e in expected for w in e]
    seen = {}
    for w, h in zip(flat, words.hashes().tolist()):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    shingles, first = shingle_hashes(words.hashes(), words.first, 5)
    wanted = [[tuple(e[k:k + 5]) for k in range(max(1, len(e) - 4))] if e else [] for e in expected]
    assert np.diff(first).tolist() == list(map(len, wanted))
    seen = {}
    for s, h in zip([s for w in wanted for s in w], shingles.tolist()):
        assert seen.setdefault(s, h) == h
    assert len(set(seen.values())) == len(seen)


def test_hash_does_not_depend_on_the_place_in_the_buffer():
    rng = random.Random(1)
    word = "abc" * 30000
    texts = ["p" * rng.randrange(1, 70000) + " " + word for _ in range(4)]
    words = split_words(pa.array(texts))
    assert len(set(words.hashes()[1::2].tolist())) == 1


def thue_morse(letters="ab", n=2048):
    """Two words of n letters that any polynomial modulo 2^64 takes for one."""
    one = "".join(letters[bin(k).count("1") % 2] for k in range(n))
    return one, one.translate(str.maketrans(letters, letters[::-1]))


def test_no_collision_by_construction():
    words = split_words(pa.array([" ".join(thue_morse()), " ".join(thue_morse("xy", 4096))]))
    assert len(set(words.hashes().tolist())) == 4
    # blocks in another order, and a word that ends where another has zeros
    words = split_words(pa.array(["abcdefgh12345678 12345678abcdefgh a a\x00 abcdefgh abcdefgh\x00"]))
    assert len(set(words.hashes().tolist())) == 6


def test_pack_round_trip():
    a = np.sort(np.random.default_rng(0).integers(0, 2 ** 63, 1000).astype(np.uint64))
    b = np.array([1.5, -2.0])
    x, y, z = unpack(pack(delta(a), b, np.zeros(0, np.int32)))
    assert (undelta(x) == a).all() and (y == b).all() and len(z) == 0 and z.dtype == np.int32
