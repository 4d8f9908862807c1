"""LM scoring by an interpolated modified Kneser-Ney model of any order from 2.

First the distinct words are counted and numbered: their hashes lie sorted in
the shared folder, and a word's number is its place there.  Grams then travel
as numbers, a few bytes a token.  Counting goes from the highest order N down,
over packed arrays: texts -> (N tokens, count) per task -> shards by the hash
of the gram's context, its first N - 1 tokens.  There counts become final, and
so do the statistics of every context, as all its grams are in one shard.
Each gram type of order k then adds one to the continuation count of its last
k - 1 tokens, which is the count of order k - 1.  Every shard stores its part
of the model as sorted hash arrays with counts beside them, in the shared
folder.  Grams and contexts are known by 40 bits of their hash within a shard,
so of a million grams in a shard one unseen gram in a million is taken for one
of them; words are known by all 64.

Scoring maps those files into memory and looks up the distinct words and all
grams and contexts of a slice of texts in sorted order, so a worker touches each
page of the model at most once per slice and holds none of it on its heap.  What
depends on one word alone is found once per distinct word.  Beside sorted prints
lies where every ``APART``-th part of their range begins, so a search starts
within about ``APART`` prints of its place.

p(w | h) = (a(hw) - D(a(hw))) / a(h) + g(h) * p(w | h without its first token),
and p(w) from the number of different words before w, interpolated with
1 / (V + 1).  Texts begin with N - 1 start tokens, so each context is whole.
Grams that begin with a start token have continuation counts at the lower
orders like all others, which are 1 there: nothing but more start tokens
stands before them.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.frames import (
    delta, distinct, map_slices, pack, remove_tables, shard_bounds, shard_of, shuffle_partitions, slices, sort_order, undelta,
    unpack, write_scratch,
)
from tillroll.llm.words import mix, split_words
from tillroll.session import scratch_path

_U = np.uint64
END = _U(0x0E4D0E4D0E4D0E4D)     # hash of the end of a text
START = _U(0)                    # number of a start token; words count from 1
UNKNOWN = _U(1) << _U(40)        # numbers from here on: words that training did not see
PAIRS_AT_ONCE = 3_000_000
SLICE = 2 << 20                  # bytes of text scored at once
APART = 32                       # prints between two stored places, about
PACKED = "shard int, kind int, payload binary"
WORDS, GRAMS, TALLY = 0, 1, 3


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts (words, then one end), and n + 1 offsets."""
    words = split_words(column)
    n = len(words.first) - 1
    first = words.first + np.arange(n + 1)
    out = np.empty(first[-1], dtype=_U)
    last = np.zeros(len(out), dtype=bool)
    last[first[1:] - 1] = True
    out[last] = END
    out[~last] = words.hashes()
    return out, first


def grams(word: np.ndarray, first: np.ndarray, order: int) -> list[np.ndarray]:
    """The token itself (last) and the order - 1 tokens before it, the farthest first."""
    place = np.arange(len(word)) - np.repeat(first[:-1], np.diff(first))
    out = [word]
    for back in range(1, order):
        out.insert(0, np.where(place >= back, np.roll(word, back), word.dtype.type(START)))
    return out


def gram_hash(columns: list[np.ndarray]) -> np.ndarray:
    return _followed_by(_begun(columns[0], len(columns)), columns[1:])


def _begun(word: np.ndarray, order: int) -> np.ndarray:
    """What ``gram_hash`` of a gram of ``order`` tokens makes of the first."""
    return mix(np.full(len(word), order, dtype=_U) * _U(0x9E3779B97F4A7C15) + word)


def _followed_by(out: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
    for word in columns:
        out = mix(out * _U(0x9E3779B97F4A7C15) + word)
    return out


def _merged(columns: list[np.ndarray], *values: np.ndarray):
    """Distinct grams sorted by hash: (hashes, columns, sums of the values)."""
    g = gram_hash(columns)
    order = sort_order(g)
    g = g[order]
    at = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else order
    kept = order[at]
    return g[at], [c[kept] for c in columns], [np.add.reduceat(v[order], at, dtype=np.int64) if len(at) else v[:0].astype(np.int64)
                                               for v in values]


def _gram_rows(columns: list[np.ndarray], counts: np.ndarray, shards: int) -> list[tuple[int, int, bytes]]:
    """Distinct grams packed for the shards of their contexts (words: of their own hash)."""
    _, columns, (counts,) = _merged(columns, counts)
    shard = shard_of(gram_hash(columns[:-1] or columns), shards)
    # One sort by shard and first token (below 2^32), roughly by the second: what lies together packs well.
    key = shard.astype(_U) << _U(int(columns[0].max(initial=0)).bit_length() + 8) | columns[0].astype(_U) << _U(8)
    if len(columns) > 2 and len(shard):
        key |= columns[1] >> _U(max(0, int(columns[1].max()).bit_length() - 8))
    order = sort_order(key)
    bounds = np.searchsorted(shard[order], np.arange(shards + 1))
    rows = []
    for s in np.flatnonzero(np.diff(bounds)).tolist():
        part = order[bounds[s]:bounds[s + 1]]
        rows.append((s, GRAMS, pack(_smallest(delta(columns[0][part])), *[_smallest(c[part]) for c in columns[1:]],
                                    _smallest(counts[part]))))
    return rows


def _sum_by(order_keys: tuple[np.ndarray, ...], *values: np.ndarray):
    """Distinct keys in sorted order (first key first) and sums of the values."""
    order = sort_order(order_keys[0]) if len(order_keys) == 1 else np.lexsort(order_keys[::-1])
    keys = [k[order] for k in order_keys]
    new = np.zeros(len(order), dtype=bool)
    if len(order):
        new[0] = True
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    at = np.flatnonzero(new)
    sums = [np.add.reduceat(v[order], at) if len(at) else v[:0] for v in values]
    return [k[at] for k in keys], sums


def _batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()),
         pa.array([r[2] for r in rows], pa.binary())], ["shard", "kind", "payload"])


def _count_words(shards: int):
    """Distinct words of a task's texts with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts, held = [], [], 0
        for piece in slices(batches, limit=SLICE):
            h, n = np.unique(tokens(piece.column("text"))[0], return_counts=True)
            hashes.append(h)
            counts.append(n)
            held += len(h)
            if held >= PAIRS_AT_ONCE:
                yield flush(hashes, counts)
                hashes, counts, held = [], [], 0
        if held:
            yield flush(hashes, counts)

    def flush(hashes: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        (h,), (n,) = _sum_by((np.concatenate(hashes),), np.concatenate(counts))
        return _batch([(s, WORDS, pack(delta(h[part]), _smallest(n[part]))) for s, part in _shards(h, shards)])
    return run


def _store_words(folder: str):
    """One shard of words, stored: hashes and counts; the shard with its words and tokens goes on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts, shard = [], [], -1
        for s, _, payload in _payloads(batches):
            shard = s
            h, n = unpack(payload)
            hashes.append(undelta(h))
            counts.append(n.astype(np.int64))
        if hashes:
            (h,), (n,) = _sum_by((np.concatenate(hashes),), np.concatenate(counts))
            _store(folder, f"words-{shard:05d}", h, _smallest(n))
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([len(h)], pa.int64()), pa.array([n.sum()], pa.int64())], ["shard", "n", "tokens"])
    return run


def numbered(stored, hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and count of each word: its place among all words, from 1; words not stored get numbers of their own."""
    words, which = distinct(hashes)
    number, count = _numbers(stored, words, offsets)
    return number[which], count[which]


def _numbers(stored, words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and count of distinct words, sorted by hash."""
    place, count = stored.places("words", words, len(offsets))
    shard = shard_of(words, len(offsets))
    number = np.where(place >= 0, offsets[shard] + place + 1, 0).astype(_U)
    unseen = place < 0
    number[unseen] = UNKNOWN | words[unseen] >> _U(1)
    return number, count


def _count(folder: str, shards: int, order: int, offsets: np.ndarray):
    def flush(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*parts)]
        return _batch(_gram_rows(columns, np.ones(len(columns[-1]), np.uint8), shards))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for piece in slices(batches, limit=SLICE):
            word, first = tokens(piece.column("text"))
            number = numbered(arrays(folder), word, offsets)[0]
            small = np.uint32 if number.max(initial=0) < 1 << 32 else _U
            parts.append(grams(number.astype(small), first, order))
            held += len(word)
            if held * order >= 2 * PAIRS_AT_ONCE:
                yield flush(parts)
                parts, held = [], 0
        if parts:
            yield flush(parts)
    return run


def _shards(sorted_hashes: np.ndarray, shards: int) -> Iterator[tuple[int, slice]]:
    bounds = shard_bounds(sorted_hashes, shards)
    for s in np.flatnonzero(np.diff(bounds)):
        yield int(s), slice(bounds[s], bounds[s + 1])


def _smallest(values: np.ndarray) -> np.ndarray:
    most = int(values.max(initial=0))
    return values.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if most <= np.iinfo(t).max))


def _store(folder: str, name: str, *arrays: np.ndarray) -> None:
    """One file per array, written under another name first: a repeated task replaces its own file whole."""
    system, root = fs.FileSystem.from_uri(folder)
    for k, a in enumerate(arrays):
        temporary = f"{root}/.{name}-{k}-{uuid.uuid4().hex}"
        with system.open_output_stream(temporary) as out:
            with io.BytesIO() as head:
                np.lib.format.write_array_header_1_0(head, np.lib.format.header_data_from_array_1_0(a))
                out.write(head.getvalue())
            out.write(np.ascontiguousarray(a).view(np.uint8).data)
        system.move(temporary, f"{root}/{name}-{k}.npy")


def _store_prints(folder: str, name: str, upper: np.ndarray, *arrays: np.ndarray) -> None:
    _store(folder, name, upper, *arrays)
    _store(folder, f"{name}-places", _places(upper))


def _tally(counts: np.ndarray) -> np.ndarray:
    return np.array([np.count_nonzero(counts == k) for k in (1, 2, 3, 4)] + [len(counts)], np.int64)


def _payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
    for batch in batches:
        for s, kind, payload in zip(batch.column("shard").to_pylist(), batch.column("kind").to_pylist(),
                                    batch.column("payload")):
            yield s, kind, payload.as_py()


def _unpacked(payload: bytes) -> list[np.ndarray]:
    """The columns of grams and their counts, as ``_gram_rows`` packs them."""
    first, *columns, counts = unpack(payload)
    small = np.uint32 if int(first.sum(dtype=_U)) < 1 << 32 else _U
    return [np.cumsum(first, dtype=small), *columns, counts]


def _prints(sorted_hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The upper 40 bits of hashes, as 32 and 8."""
    return (sorted_hashes >> _U(32)).astype(np.uint32), (sorted_hashes >> _U(24)).astype(np.uint8)


def _places(sorted_upper: np.ndarray) -> np.ndarray:
    """Where each of equal parts of the range of 32 bits begins in sorted values, and their end: about ``APART`` values a part."""
    bits = max(0, (len(sorted_upper) // APART).bit_length() - 1)
    parts = np.arange(1 << bits, dtype=_U) << _U(32 - bits)
    return np.append(np.searchsorted(sorted_upper, parts.astype(np.uint32)), len(sorted_upper)).astype(np.uint32)


def search(sorted_upper: np.ndarray, places: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """``np.searchsorted`` of 32-bit values, by the ``_places`` of the sorted ones."""
    part = wanted.astype(np.int64) >> (32 - (len(places) - 1).bit_length() + 1)
    at, end = places[part].astype(np.int64), places[part + 1].astype(np.int64)
    for k in range(int((end - at).max(initial=0)).bit_length() - 1, -1, -1):     # halving, all at once
        lower = sorted_upper.take(at + ((1 << k) - 1), mode="clip") < wanted
        at += np.multiply(lower, 1 << k, dtype=np.int64)
    return np.minimum(at, len(sorted_upper))


def _coded(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Rows of numbers as codes from 1, and the columns of the distinct rows (0: zeros): most rows are alike."""
    code = np.zeros(len(columns[0]), np.int64)
    for c in columns:
        values, which = distinct(c.astype(_U))
        code = distinct((code * len(values) + which).astype(_U))[1]
    some = np.empty(int(code.max(initial=-1)) + 1, np.int64)
    some[code] = np.arange(len(code))            # any row of each code
    return [_smallest(code + 1), *[_smallest(np.concatenate([[0], c[some]])) for c in columns]]


def print_keys(shard: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Shard and 40 bits of hashes as one number, ordered as the shards store them."""
    return shard.astype(_U) << _U(40) | hashes >> _U(24)


def _contexts(columns: list[np.ndarray], counts: np.ndarray) -> list[np.ndarray]:
    """Of each context: its print, the sum of its grams' counts, and how many of them count 1, 2, 3 or more."""
    h = gram_hash(columns)
    by = sort_order(h)
    h, counts = h[by], counts[by]
    at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    prints = _prints(h[at])
    del h, by
    sums = [np.add.reduceat(counts, at)]
    for few in (counts == 1, counts == 2, counts >= 3):
        sums.append(np.add.reduceat(few, at, dtype=np.int64))
    return [*prints, *_coded(sums)]


def _grams(folder: str, shards: int, order: int):
    """Final counts of one shard's grams and contexts; the grams of the next lower order go on to their shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, shard = [], -1
        for s, _, payload in _payloads(batches):
            shard = s
            parts.append(_unpacked(payload))
        if not parts:
            return
        *columns, count = [np.concatenate(c) for c in zip(*parts)]
        parts.clear()
        g, columns, (c,) = _merged(columns, count)
        del count
        _store_prints(folder, f"grams{order}-{shard:05d}", *_prints(g), _smallest(c))
        yield _batch([(0, TALLY, pack(_tally(c)))])
        del g
        _store_prints(folder, f"contexts{order}-{shard:05d}", *_contexts(columns[:-1], c))
        c = np.ones(len(c), np.uint8)
        yield _batch(_gram_rows(columns[1:], c, shards))
    return run


def _followed(folder: str):
    """Final arrays of one shard of words: the hash of its number, and how many words stand before it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, counts, shard = [], [], -1
        for s, _, payload in _payloads(batches):
            shard = s
            number, n = _unpacked(payload)
            numbers.append(number)
            counts.append(n.astype(np.int64))
        if not numbers:
            return
        h, (number,), (n,) = _merged([np.concatenate(numbers)], np.concatenate(counts))
        _store(folder, f"followed-{shard:05d}", h, _smallest(n))
        # The start is a context; where it is padding, also a gram's last token.
        yield pa.RecordBatch.from_arrays([pa.array([pack(_tally(n[number != START]))], pa.binary())], ["payload"])
    return run


def discounts(tally: np.ndarray) -> np.ndarray:
    """D for counts 0, 1, 2 and 3+, from how many types have counts 1 to 4 (0.5, 1, 1.5 where too few)."""
    n1, n2, n3, n4 = (float(x) for x in tally[:4])
    if min(n1, n2, n3) == 0:
        return np.array([0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    d = np.array([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.clip(d, 0, [0, 1, 2, 3])


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the numbers that every lookup needs."""

    folder: str
    shards: int
    order: int
    offsets: np.ndarray      # words in the shards before each
    n_tokens: int
    n_types: int
    gram_discounts: dict[int, np.ndarray]    # by order, from 2
    word_discounts: np.ndarray
    pair_types: int
    rest: float              # mass that p(w) leaves to the uniform part


def train(docs: DataFrame, text_col: str = "text", order: int = 3) -> Model:
    """Count ``docs`` whole, in grams of up to ``order`` tokens, and store the model in the shared folder.

    A null text is empty: it counts one end.  An empty table gives a model
    that knows no token and gives each the probability 1 / (V + 1) = 1.
    """
    if order < 2:
        raise ValueError("order must be 2 or more")
    spark = docs.sparkSession
    shards = shuffle_partitions(spark)
    folder = scratch_path(spark, "grams")
    if ":" not in folder.split("/")[0]:
        folder = f"file://{folder}"
    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root)
    texts = docs.select(F.col(text_col).alias("text"))
    stored = write_scratch(texts.mapInArrow(_count_words(shards), PACKED).repartitionById(shards, F.col("shard"))
                           .mapInArrow(_store_words(folder), "shard int, n long, tokens long"), "words").collect()   # a row a shard
    sizes, n_tokens = np.zeros(shards, np.int64), sum(r.tokens for r in stored)
    sizes[[r.shard for r in stored]] = [r.n for r in stored]
    offsets, n_types = np.cumsum(sizes) - sizes, int(sizes.sum())
    rows = texts.mapInArrow(_count(folder, shards, order, offsets), PACKED)
    tallies, above = {}, None
    for k in range(order, 1, -1):
        dealt = rows.repartitionById(shards, F.col("shard"))
        done = write_scratch(dealt.mapInArrow(_grams(folder, shards, k), PACKED), f"grams-{k}")
        remove_tables(spark, above)              # their grams are counted
        # One row of a few numbers per shard comes to the driver, here and below.
        found = [unpack(r["payload"])[0] for r in done.filter(F.col("kind") == TALLY).select("payload").collect()]
        tallies[k] = np.sum(found, axis=0) if found else np.zeros(5, np.int64)
        rows, above = done.filter(F.col("kind") == GRAMS), done
    words = rows.repartitionById(shards, F.col("shard")).mapInArrow(_followed(folder), "payload binary")
    word_rows = [unpack(r["payload"])[0] for r in words.collect()]
    word_tally = np.sum(word_rows, axis=0) if word_rows else np.zeros(5, np.int64)
    remove_tables(spark, above)
    d = discounts(word_tally)
    types = int(tallies[2][4])
    more = word_tally[4] - word_tally[0] - word_tally[1]
    rest = (d[1] * word_tally[0] + d[2] * word_tally[1] + d[3] * more) / types if types else 1.0
    return Model(folder, shards, order, offsets, int(n_tokens), int(n_types), {k: discounts(t) for k, t in tallies.items()}, d,
                 types, float(rest))


class Arrays:
    """The model's files, mapped into memory on first use."""

    def __init__(self, folder: str):
        self.system, self.root = fs.FileSystem.from_uri(folder)
        self.local = isinstance(self.system, fs.LocalFileSystem)
        self.open: dict[str, np.ndarray | None] = {}

    def get(self, name: str) -> np.ndarray | None:
        if name not in self.open:
            path = f"{self.root}/{name}.npy"
            if self.system.get_file_info(path).type == fs.FileType.NotFound:
                self.open[name] = None
            elif self.local:
                self.open[name] = np.asarray(np.load(path, mmap_mode="r"))    # a plain view of the map: indexing is faster
            else:                                # fetch once per worker; the name goes at once, the map stays
                with tempfile.NamedTemporaryFile(suffix=".npy") as copy, self.system.open_input_stream(path) as source:
                    while part := source.read(1 << 24):
                        copy.write(part)
                    copy.flush()
                    self.open[name] = np.asarray(np.load(copy.name, mmap_mode="r"))
        return self.open[name]

    def places(self, kind: str, hashes: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
        """Place of sorted hashes in their shard's array (-1 where unknown), and the value beside it (0)."""
        place, value = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        for s, part in _shards(hashes, shards):
            keys = self.get(f"{kind}-{s:05d}-0")
            if keys is not None:
                at = np.minimum(np.searchsorted(keys, hashes[part]), len(keys) - 1)
                have = np.flatnonzero(keys[at] == hashes[part])
                place[part.start + have] = at[have]
                value[part.start + have] = self.get(f"{kind}-{s:05d}-1")[at[have]]
        return place, value

    def find_prints(self, kind: str, keys: np.ndarray, columns: int = 0) -> list[np.ndarray]:
        """Values of ``print_keys``, sorted and maybe repeated, in their shards, 0 where unknown: one, or ``columns`` that ``_coded`` stored."""
        out = [np.zeros(len(keys), np.int64) for _ in range(columns or 1)]
        shard = (keys >> _U(40)).astype(np.int64)
        names, first = np.unique(shard, return_index=True)
        for s, low, high in zip(names.tolist(), first, np.append(first[1:], len(keys))):
            upper = self.get(f"{kind}-{s:05d}-0")
            if upper is None:
                continue
            lower = self.get(f"{kind}-{s:05d}-1")
            wanted, rest = (keys[low:high] >> _U(8)).astype(np.uint32), keys[low:high].astype(np.uint8)
            places = self.get(f"{kind}-{s:05d}-places-0")
            at = search(upper, _places(upper) if places is None else places, wanted)
            left = np.flatnonzero(upper.take(at, mode="clip") == wanted)     # behind the last lie only larger ones
            at = at.take(left)
            while len(left):                     # more than one step where upper bits agree, which is rare
                same = lower.take(at) == rest.take(left)
                found = self.get(f"{kind}-{s:05d}-2").take(at[same])
                target = left[same] + low
                for k, x in enumerate(out):
                    x[target] = self.get(f"{kind}-{s:05d}-{k + 3}").take(found) if columns else found
                if same.all():
                    break
                left, at = left[~same], at[~same] + 1
                more = upper.take(at, mode="clip") == wanted[left]
                more &= at < len(upper)
                left, at = left[more], at[more]
        return out

    def find(self, kind: str, hashes: np.ndarray, shards: int, columns: int) -> list[np.ndarray]:
        """Values of sorted hashes in the first ``columns`` arrays; 0 where unknown."""
        out = [np.zeros(len(hashes), np.int64) for _ in range(columns)]
        for s, part in _shards(hashes, shards):
            keys = self.get(f"{kind}-{s:05d}-0")
            if keys is None:
                continue
            wanted = hashes[part]
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            have = np.flatnonzero(keys[at] == wanted)
            for k, x in enumerate(out):
                x[part.start + have] = self.get(f"{kind}-{s:05d}-{k + 1}")[at[have]]
        return out


_ARRAYS: dict[str, Arrays] = {}


def arrays(folder: str) -> Arrays:
    if folder not in _ARRAYS:
        _ARRAYS.clear()
        _ARRAYS[folder] = Arrays(folder)
    return _ARRAYS[folder]


def _sorted_keys(shard: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = print_keys(shard, hashes)
    by = sort_order(keys)
    return keys[by], by


def _unsorted(values: np.ndarray, by: np.ndarray) -> np.ndarray:
    out = np.empty_like(values)
    out[by] = values
    return out


def _weights(stored: Arrays, k: int, context: np.ndarray, model: Model, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the counts after each context of grams of order k, and the weight of the next lower order."""
    keys, by = _sorted_keys(shard_of(context, model.shards), context)
    total, ones, twos, more = stored.find_prints(f"contexts{k}", keys, 4)
    back = np.divide(d[1] * ones + d[2] * twos + d[3] * more, total, out=np.ones(len(total)), where=total > 0)
    return _unsorted(total, by), _unsorted(back, by)


def _score(model: Model):
    def run(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        hashes, first = tokens(piece.column("text"))
        n = len(first) - 1
        owner = np.repeat(np.arange(n), np.diff(first))
        stored = arrays(model.folder)
        words, which = distinct(hashes)
        number, count = _numbers(stored, words, model.offsets)
        known = (count > 0)[which]
        base = np.log10((count + 1) / (model.n_tokens + (model.n_types + 1)))[which]
        number = np.append(number, START)                        # the start is the last of the distinct tokens
        token = [t - 1 for t in grams(which + 1, first, model.order)]    # -1: the start
        keys = gram_hash([number])
        by = sort_order(keys)
        followed = _unsorted(stored.find("followed", keys[by], model.shards, 1)[0], by)
        d = model.word_discounts
        lower = np.full(len(keys), model.rest / (model.n_types + 1))
        if model.pair_types:
            lower += (followed - d[np.minimum(followed, 3)]) / model.pair_types
        chance = lower[token[-1]]
        columns = [number[t] for t in token]
        for k in range(2, model.order + 1):
            d = model.gram_discounts[k]
            if k == 2:                                           # the context is one token
                total, back = _weights(stored, k, keys, model, d)
                total, back, shard = total[token[-2]], back[token[-2]], shard_of(keys, model.shards)[token[-2]]
            else:
                context = _followed_by(_begun(number, k - 1)[token[-k]], columns[1 - k:-1])
                total, back = _weights(stored, k, context, model, d)
                shard = shard_of(context, model.shards)
            sought, by = _sorted_keys(shard, _followed_by(_begun(number, k)[token[-k]], columns[1 - k:]))
            seen = _unsorted(stored.find_prints(f"grams{k}", sought)[0], by)
            chance = (seen - d[np.minimum(seen, 3)]) / np.maximum(total, 1) + back * chance
        logs = np.log10(chance)
        kept = [k for k, name in enumerate(piece.schema.names) if name != "text"]
        yield pa.RecordBatch.from_arrays(
            [*[piece.column(k) for k in kept], pa.array(np.diff(first).astype(np.int64)),
             pa.array(np.bincount(owner, weights=known, minlength=n).astype(np.int64)),
             pa.array(np.full(n, model.n_tokens, np.int64)),
             pa.array(np.bincount(owner, weights=base, minlength=n)),
             pa.array(np.bincount(owner, weights=logs, minlength=n))],
            [*[piece.schema.names[k] for k in kept], "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def score_texts(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns ``keep``, with n_tokens, n_known, train_tokens, base_score, score and perplexity.

    ``score`` is the model's log10 probability of the whole text and its end,
    ``perplexity`` is per token, ``base_score`` an add-one unigram's log10
    probability.  A null text scores as an empty one (its end alone);
    repeated rows score alike; other columns are left out.
    """
    chosen = docs.select(*[F.col(c) for c in keep], F.col(text_col).alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.drop("text").schema.fields)
    scored = map_slices(chosen, _score(model), schema + ", n_tokens long, n_known long, train_tokens long, "
                        "base_score double, score double", limit=SLICE)
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
