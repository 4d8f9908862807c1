"""Token counts that follow edits: a segment tree of pre-tokens per document.

A byte-level BPE cuts text into pre-tokens by a pattern and encodes each by
itself, so a document's count is a sum over pre-tokens.  The tree holds the
code points and tokens of segments of pre-tokens and of all spans of segments
above them.  An edit descends to the pre-tokens that it touches, cuts the new
text anew from a little before them, until a cut falls on an old one behind
the edit, encodes only those pre-tokens and updates the sums above them.
That holds for the patterns in BOUNDED; another pattern's cuts may depend on
any text before or behind, so there an edit cuts and encodes the whole text.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.frames import map_slices

SEGMENT = 64                 # pre-tokens of a fresh segment
CONTEXT = 3                  # code points behind a pre-token that its cut may depend on, for these patterns:
BOUNDED = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+",)
REMEMBERED = 300_000


class PreTokenCounter:
    """Cuts text by the vocabulary's pattern and counts the tokens of pre-tokens, remembered per worker."""

    def __init__(self, ranks: bytes, pattern: str):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encode = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=table,
                                        special_tokens={}).encode_ordinary
        self.pattern = regex.compile(pattern)
        self.bounded = pattern in BOUNDED
        self.known: dict[str, int] = {}

    def counts(self, parts: list[str]) -> list[int]:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for p in set(parts):
            if p not in known:
                known[p] = len(self.encode(p))
        return [known[p] for p in parts]


class TokenTree:
    """Pre-tokens of one text in segments; sums of code points and tokens over all spans of segments."""

    def __init__(self, lengths: list[int], counts: list[int]):
        self._fill([lengths[k:k + SEGMENT] for k in range(0, len(lengths), SEGMENT)] or [[]],
                   [counts[k:k + SEGMENT] for k in range(0, len(counts), SEGMENT)] or [[]])

    def _fill(self, lengths: list[list[int]], counts: list[list[int]]) -> None:
        self.lengths, self.counts = lengths, counts
        self.leaves = 1 << (len(lengths) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.leaves), [0] * (2 * self.leaves)
        for s, (a, b) in enumerate(zip(lengths, counts)):
            self.chars[self.leaves + s], self.tokens[self.leaves + s] = sum(a), sum(b)
        for node in range(self.leaves - 1, 0, -1):
            self._add_up(node)

    def _add_up(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def locate(self, offset: int) -> tuple[int, int]:
        """(segment that holds the code point at ``offset``, code points before that segment)."""
        node, before = 1, 0
        while node < self.leaves:
            node *= 2
            if before + self.chars[node] <= offset:
                before += self.chars[node]
                node += 1
        return min(node - self.leaves, len(self.lengths) - 1), before

    def _replace(self, first: int, last: int, lengths: list[int], counts: list[int]) -> None:
        """Pre-tokens of segments first..last give way; sums are updated on the paths to the root."""
        if len(lengths) > 4 * SEGMENT:           # grown: deal the segments anew
            flat = lambda old, new: [x for s in (*old[:first], new, *old[last + 1:]) for x in s]
            self.__init__(flat(self.lengths, lengths), flat(self.counts, counts))
            return
        for s in range(first, last + 1):
            self.lengths[s], self.counts[s] = (lengths, counts) if s == first else ([], [])
            self.chars[self.leaves + s], self.tokens[self.leaves + s] = sum(self.lengths[s]), sum(self.counts[s])
        level = {(self.leaves + s) // 2 for s in range(first, last + 1)}
        while level and 0 not in level:
            for node in level:
                self._add_up(node)
            level = {node // 2 for node in level}

    def edit(self, text: str, start: int, end: int, replacement: str, counter: PreTokenCounter) -> tuple[str, int]:
        """Apply text[start:end] = replacement; (new text, pre-tokens encoded anew)."""
        new = text[:start] + replacement + text[end:]
        if not counter.bounded:
            parts = counter.pattern.findall(new)
            self.__init__(list(map(len, parts)), counter.counts(parts))
            return new, len(parts)
        segment, at = self.locate(max(0, start - CONTEXT - 1))
        lengths, counts = list(self.lengths[segment]), list(self.counts[segment])
        k = 0
        while k < len(lengths) and at + lengths[k] <= start - CONTEXT:
            at += lengths[k]
            k += 1
        kept_lengths, kept_counts = lengths[:k], counts[:k]
        # Walk the old cuts beside the new ones, until two meet behind the edit.
        last, position, shift = segment, at, len(new) - len(text)
        fresh: list[str] = []
        met = False
        for match in counter.pattern.finditer(new, at):
            if match.start() >= start + len(replacement):
                old = match.start() - shift
                while position < old:
                    while k == len(lengths):
                        last += 1
                        lengths, counts, k = self.lengths[last], self.counts[last], 0
                    position += lengths[k]
                    k += 1
                if position == old and old >= end:
                    met = True
                    break
            fresh.append(match.group())
        if not met:
            last, lengths, counts, k = len(self.lengths) - 1, [], [], 0
        self._replace(segment, last, kept_lengths + [len(p) for p in fresh] + list(lengths[k:]),
                      kept_counts + counter.counts(fresh) + list(counts[k:]))
        return new, len(fresh)


_COUNTERS: dict[int, PreTokenCounter] = {}


def _counter(ranks: bytes, pattern: str) -> PreTokenCounter:
    key = hash((ranks, pattern))
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = PreTokenCounter(ranks, pattern)
    return _COUNTERS[key]


Edit = Callable[[str], tuple[int, int, str]]


def count_with_edits(docs: DataFrame, ranks_path: str, pattern: str, edits: list[Edit],
                     keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns ``keep``, n_tokens, n_pretokens, and arrays ``after`` and ``reencoded`` with one entry per edit.

    Each edit gives (start, end, replacement) in code points of the text as
    earlier edits left it; ``after`` is the count then, ``reencoded`` how many
    pre-tokens had to be encoded for it.  A null text is empty; bounds are
    clipped to the text; repeated rows each give a row; other columns are
    left out.
    """
    with open(ranks_path, "rb") as f:
        ranks = f.read()

    def run(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        counter = _counter(ranks, pattern)
        totals, sizes, after, again = [], [], [], []
        for text in piece.column("text").to_pylist():
            text = text or ""
            parts = counter.pattern.findall(text)
            tree = TokenTree(list(map(len, parts)), counter.counts(parts))
            totals.append(tree.total)
            sizes.append(len(parts))
            rows = []
            for edit in edits:
                start, end, replacement = edit(text)
                start = min(max(0, start), len(text))
                text, n = tree.edit(text, start, min(max(start, end), len(text)), replacement, counter)
                rows.append((tree.total, n))
            after.append([a for a, _ in rows])
            again.append([b for _, b in rows])
        kept = [k for k, name in enumerate(piece.schema.names) if name != "text"]
        longs = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*[piece.column(k) for k in kept], pa.array(totals, pa.int64()), pa.array(sizes, pa.int64()),
             pa.array(after, longs), pa.array(again, longs)],
            [*[piece.schema.names[k] for k in kept], "n_tokens", "n_pretokens", "after", "reencoded"])
    chosen = docs.select(*[F.col(c) for c in keep], F.col(text_col).alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.drop("text").schema.fields)
    return map_slices(chosen, run, schema + ", n_tokens long, n_pretokens long, after array<long>, reencoded array<long>",
                      limit=4 << 20)
