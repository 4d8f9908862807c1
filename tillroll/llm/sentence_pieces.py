"""Sentence-piece encoding and decoding that keeps byte offsets.

Normalisation walks the text by the longest prefix found in the model's
compiled character map and records, for each normalised byte, the source byte
it comes from.  Pieces are cut out of the normalised text, so each has a
normalised range, and the alignment projects it to a range of source bytes.

A piece never holds a space mark behind another character (checked when a
model is loaded), so no merge crosses from a word into the next one's mark:
words are encoded once each per task and remembered.  For models whose
normaliser only marks spaces, a slice of texts is cut, looked up and put
together as flat arrays; other models and texts take the general way.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.frames import map_slices, ship_package
from tillroll.llm.words import Words, utf8_buffer

MARK = "▁"
_MARK = MARK.encode()
REMEMBERED = 200_000         # words kept per task; more only cost time


class CharacterMap:
    """The compiled map of a normaliser: a double-array trie of byte strings and their replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.values = blob[4 + size:]

    def longest(self, text: bytes, at: int) -> tuple[bytes, int] | None:
        """(replacement, end) of the longest key that starts at ``at``."""
        units, found = self.units, None
        if not units:
            return None
        node = 0
        here = units[0]
        node ^= (here >> 10) << ((here & 0x200) >> 6)
        for end in range(at, len(text)):
            label = text[end]
            node ^= label
            here = units[node]
            if here & 0x800000FF != label:
                break
            node ^= (here >> 10) << ((here & 0x200) >> 6)
            if here >> 8 & 1:
                found = units[node] & 0x7FFFFFFF, end + 1
        if found is None:
            return None
        return self.values[found[0]:self.values.index(b"\0", found[0])], found[1]


def _char_end(text: bytes, at: int) -> int:
    lead = text[at]
    return at + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)


class Normaliser:
    def __init__(self, spec):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.trim, self.escape = (
            spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces)

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and the source offset of each of them and of the end."""
        if not text:
            return b"", np.zeros(1, np.int64)
        if not self.map.units and not self.trim and self.escape:
            source = np.frombuffer(text, np.uint8)
            align = np.repeat(np.arange(len(text) + 1), np.append(np.where(source == 32, 3, 1), 1))
            if self.prefix:
                align = np.concatenate([np.zeros(3, np.int64), align])
            return (_MARK if self.prefix else b"") + text.replace(b" ", _MARK), align
        return self._walk(text)

    def _next(self, text: bytes, at: int) -> tuple[bytes, int]:
        return self.map.longest(text, at) or (text[at:_char_end(text, at)], _char_end(text, at))

    def _walk(self, text: bytes) -> tuple[bytes, np.ndarray]:
        space = _MARK if self.escape else b" "
        out, align, at = bytearray(), [], 0
        if self.trim:
            while at < len(text):
                piece, end = self._next(text, at)
                if piece != b" ":
                    break
                at = end
            if at == len(text):
                return b"", np.array([at], np.int64)
        if self.prefix:
            out += space
            align += [at] * len(space)
        after_space = self.trim
        while at < len(text):
            piece, end = self._next(text, at)
            while after_space and piece.startswith(b" "):
                piece = piece[1:]
            if piece:
                new = piece.replace(b" ", space)
                out += new
                align += [at] * len(new)
                after_space = self.trim and piece.endswith(b" ")
            at = end
        if self.trim:
            while out.endswith(space):
                at = align[len(out) - len(space)]
                del out[-len(space):]
                del align[len(out):]
        return bytes(out), np.array([*align, at], np.int64)


def _same_words(words: Words, model: np.ndarray) -> bool:
    """Whether every word is spelled like the word whose index ``model`` gives (the first one of its hash)."""
    values, first = words.blocks(lower=False)
    n = np.diff(first)
    if not np.array_equal(words.ends - words.starts, (words.ends - words.starts)[model]):
        return False
    at = np.repeat(first[:-1][model] - first[:-1], n) + np.arange(len(values))
    return np.array_equal(values, values[at])


class PieceCoder:
    """Encoder and decoder of one model, given as the bytes of its file."""

    def __init__(self, model: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto.FromString(model)
        if any(p.type == proto.ModelProto.SentencePiece.USER_DEFINED for p in spec.pieces):
            raise ValueError("models with user-defined pieces are not supported")
        self.normalise = Normaliser(spec.normalizer_spec)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.by_word = not any(MARK in p.piece.lstrip(MARK) for p in spec.pieces
                               if p.type == proto.ModelProto.SentencePiece.NORMAL)
        kinds = proto.ModelProto.SentencePiece
        self.lengths = np.array([1 if p.type == kinds.BYTE else len(p.piece.encode()) for p in spec.pieces], np.int64)
        surfaces = [bytes([int(p.piece[3:5], 16)]) if p.type == kinds.BYTE else
                    b"" if p.type == kinds.CONTROL else p.piece.replace(MARK, " ").encode() for p in spec.pieces]
        self.widths = np.array([len(x) for x in surfaces], np.int64)
        self.starts = np.cumsum(self.widths) - self.widths
        self.surface = np.frombuffer(b"".join(surfaces), np.uint8)
        self.marks = (self.by_word and not self.normalise.map.units and not self.normalise.trim
                      and self.normalise.escape and self.normalise.prefix)
        self.plain = np.array([p.type in (kinds.NORMAL, kinds.BYTE) for p in spec.pieces])
        self.control = np.array([p.type == kinds.CONTROL for p in spec.pieces])
        self.by_hash: dict[int, tuple[bytes, bytes]] = {}          # hash -> the word and its ids
        spec.normalizer_spec.precompiled_charsmap = b""
        spec.normalizer_spec.add_dummy_prefix = False
        spec.normalizer_spec.remove_extra_whitespaces = False
        self.cutter = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
        self.known: dict[str, bytes] = {}
        self.words = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+", re.DOTALL).findall

    def _cut(self, parts: list[list[str]]) -> list[np.ndarray]:
        wanted = set().union(*parts)
        new = [w for w in wanted if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(wanted)
        for low in range(0, len(new), 20_000):
            some = new[low:low + 20_000]
            for word, ids in zip(some, self.cutter.encode(some, num_threads=1)):
                self.known[word] = np.array(ids, np.int32).tobytes()
        find = self.known.__getitem__
        return [np.frombuffer(b"".join(map(find, p)), np.int32) for p in parts]

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, begins, ends) of each text; source byte offsets.

        A character that no piece holds and bytes cannot spell becomes one
        unknown id over its whole run, like the library's.
        """
        normal = [self.normalise(t.encode()) for t in texts]
        strings = [n.decode() for n, _ in normal]
        cut = self._cut([self.words(s) if self.by_word else [s] * bool(s) for s in strings])
        out = []
        for ids, text, (raw, align) in zip(cut, strings, normal):
            ends = np.cumsum(self.lengths[ids])
            if len(ids) and ends[-1] != len(raw):      # unknown ids: their width comes from the library
                pieces = self.cutter.encode(text, return_type="proto").pieces
                ids = np.array([p.id for p in pieces], np.int32)
                ends = np.cumsum([len(p.surface.encode()) for p in pieces])
            begins = np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ids) else ends
            out.append((ids, align[begins].astype(np.int32), align[ends].astype(np.int32)))
        return out

    def encode_flat(self, column: pa.Array) -> tuple[np.ndarray, ...] | None:
        """(ids, begins, ends, n + 1 offsets) of a column of texts; None if it needs the general way.

        Each text gets one space in front, the normaliser's prefix, and is cut
        before every space that follows another character.
        """
        data, offsets = utf8_buffer(column)
        if not self.marks or _MARK in data.tobytes():
            return None
        filled = np.flatnonzero(np.diff(offsets))
        data = np.insert(data, offsets[filled], 32)
        first = offsets.copy()
        first[1:] += np.cumsum(np.diff(offsets) > 0)
        space = data == 32
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[1:-1] = space[1:] & ~space[:-1]
        cut[first] = True
        at = np.flatnonzero(cut)
        words = Words(data, at[:-1], at[1:], np.searchsorted(at[:-1], first))
        raw = words.hashes(lower=False)
        keys, where, which = np.unique(raw, return_index=True, return_inverse=True)
        if not _same_words(words, where[which]):
            return None
        held = self.by_hash
        wanted = keys.tolist()
        blob = data.tobytes()
        spelled = [blob[a:b] for a, b in zip(words.starts[where].tolist(), words.ends[where].tolist())]
        new = [k for k, h in enumerate(wanted) if h not in held]
        if any(h in held and held[h][0] != w for h, w in zip(wanted, spelled)):
            return None
        if len(held) + len(new) > REMEMBERED:
            held.clear()
            new = list(range(len(wanted)))
        for low in range(0, len(new), 20_000):
            some = new[low:low + 20_000]
            text = [spelled[k].decode().replace(" ", MARK) for k in some]
            for k, ids in zip(some, self.cutter.encode(text, num_threads=1)):
                held[wanted[k]] = spelled[k], np.array(ids, np.int32).tobytes()
        parts = [held[h][1] for h in wanted]
        table = np.frombuffer(b"".join(parts), np.int32)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        if not self.plain[table].all():
            return None
        starts = np.cumsum(sizes) - sizes
        n = sizes[which]
        ends_at = np.cumsum(n)
        ids = table[np.arange(n.sum()) + np.repeat(starts[which] - (ends_at - n), n)]
        id_first = np.concatenate([[0], ends_at])[words.first]
        # Offsets in the buffer, a mark being one byte there; the space in front of a text has no source byte.
        ends = np.cumsum(self.widths[ids])
        base = np.repeat(first[:-1] + 1, np.diff(id_first))
        begins = np.maximum(ends - self.widths[ids] - base, 0)
        return ids, begins.astype(np.int32), np.maximum(ends - base, 0).astype(np.int32), id_first

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids)

    def decode_flat(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of flat ids, from the pieces' surfaces; what those alone cannot tell goes to the library."""
        width = self.widths[ids]
        ends = np.cumsum(width)
        flat = self.surface[np.arange(width.sum()) + np.repeat(self.starts[ids] - (ends - width), width)].tobytes()
        borders = np.concatenate([[0], ends])[offsets].tolist()
        odd = ~(self.plain | self.control)[ids]
        odd[offsets[:-1][offsets[:-1] < offsets[1:]]] |= self.control[ids[offsets[:-1][offsets[:-1] < offsets[1:]]]] & (
            np.diff(offsets)[np.diff(offsets) > 0] > 1)
        strange = np.add.reduceat(np.append(odd, 0), offsets[:-1]) > 0 if len(ids) else np.zeros(len(offsets) - 1, bool)
        strange &= np.diff(offsets) > 0
        out = []
        for k in range(len(offsets) - 1):
            part = flat[borders[k]:borders[k + 1]]
            try:
                if strange[k]:
                    raise ValueError
                out.append(part[self.normalise.prefix and part[:1] == b" ":].decode())
            except ValueError:           # unknown ids, ids in front, or bytes that spell no character
                out.append(self.library.decode(ids[offsets[k]:offsets[k + 1]].tolist()))
        return out


_CODERS: dict[int, PieceCoder] = {}


def coder(model: bytes) -> PieceCoder:
    """One coder per worker process and model."""
    key = hash(model)
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = PieceCoder(model)
    return _CODERS[key]


def _lists(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.astype(np.int32, copy=False)))


def _general(it: PieceCoder, column: pa.Array) -> tuple[np.ndarray, ...]:
    parts = it.encode([t or "" for t in column.to_pylist()])
    offsets = np.concatenate([[0], np.cumsum([len(p[0]) for p in parts], dtype=np.int64)])
    return *(np.concatenate([p[k] for p in parts]) for k in range(3)), offsets


def _encode(model: bytes, add_bos: bool, add_eos: bool, decoded: bool):
    def run(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        it = coder(model)
        column = piece.column("text")
        sizes = np.diff(utf8_buffer(column)[1])
        ids, begins, ends, offsets = it.encode_flat(column) or _general(it, column)
        if add_eos:
            ids, begins, ends = (np.insert(x, offsets[1:], v) for x, v in (
                (ids, it.library.eos_id()), (begins, sizes), (ends, sizes)))
            offsets = offsets + np.arange(len(offsets))
        if add_bos:
            ids, begins, ends = (np.insert(x, offsets[:-1], v) for x, v in (
                (ids, it.library.bos_id()), (begins, 0), (ends, 0)))
            offsets = offsets + np.arange(len(offsets))
        kept = [k for k, name in enumerate(piece.schema.names) if name != "text"]
        columns = [_lists(x, offsets) for x in (ids, begins, ends)]
        names = ["ids", "begins", "ends"]
        if decoded:
            columns.append(pa.array(it.decode_flat(ids, offsets), pa.string()))
            names.append("decoded")
        yield pa.RecordBatch.from_arrays([*[piece.column(k) for k in kept], *columns],
                                         [*[piece.schema.names[k] for k in kept], *names])
    return run


def _decode(model: bytes):
    def run(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = piece.column("ids").cast(pa.list_(pa.int64()))
        sizes = np.array([0 if x is None else x for x in pc.list_value_length(lists).to_pylist()], np.int64)
        ids = lists.flatten().to_numpy(zero_copy_only=False)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        yield piece.append_column("decoded", pa.array(coder(model).decode_flat(ids, offsets), pa.string()))
    return run


def _columns(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def encode_pieces(docs: DataFrame, model_path: str, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text",
                  add_bos: bool = False, add_eos: bool = True, decoded: bool = False) -> DataFrame:
    """The columns ``keep`` and ``ids``, ``begins``, ``ends``: each piece's range of source bytes.

    With ``decoded`` also that column of ``decode_pieces``, in the same pass.

    Begin and end ids have empty ranges at the ends of the text.  Null and
    empty texts have the added ids alone; each repeated row gives its own
    row; other columns are left out.  Text that needs several source bytes
    for one normalised unit gives adjacent pieces the range of the unit.
    """
    with open(model_path, "rb") as f:
        model = f.read()
    chosen = docs.select(*[F.col(c) for c in keep], F.col(text_col).alias("text"))
    return map_slices(chosen, _encode(model, add_bos, add_eos, decoded),
                      _columns(chosen.drop("text")) + ", ids array<int>, begins array<int>, ends array<int>"
                      + ", decoded string" * decoded, limit=2 << 20)


def decode_pieces(encoded: DataFrame, model_path: str) -> DataFrame:
    """``encoded`` with ``decoded``, the library's decode(ids); null ids decode to the empty text."""
    ship_package(encoded.sparkSession)
    with open(model_path, "rb") as f:
        model = f.read()

    def run(batches):
        step = _decode(model)
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                yield from step(batch.slice(low, 512))
    return encoded.mapInArrow(run, _columns(encoded) + ", decoded string")
