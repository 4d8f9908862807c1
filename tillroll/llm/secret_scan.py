"""Secret scans: known forms, and strings that a primed compressor finds new.

Known forms (kinds assign, access, hex) come from fixed patterns.  Beyond
them, every long string behind a sensitive word, also one within the same run
of characters (``signature=...``), is compressed by zstandard with a dictionary primed from common identifiers and
the text around the string.  Its marginal bytes, against what the primed
compressor spends on nothing, show how much of it neither the identifiers nor
the surrounding text explain.  The compressor also codes plain symbols in fewer
bits, the more so the longer the string and the smaller its alphabet; so the
measure is a random string of the same length over the same symbols; words, in
prose or joined by marks, are spelled in the identifiers or the text around and
stay below it.  A string that compresses hardly better is reported as kind ``novel``.  Each span carries
that novelty (marginal bytes against those of the random string).

A slice of texts is first searched as one byte buffer, so that patterns run
only over texts that can hold a match.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.frames import map_slices
from tillroll.llm.words import utf8_buffer

# The known forms, and the order of kinds in results.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")       # maximal runs; shorter runs fail as a whole
KINDS = ("assign", "access", "hex", "novel")
SENSITIVE = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "api key", "auth", "bearer",
             "credential", "private key", "private_key", "access key", "access_key", "signature", "session")
# What ordinary code and prose hold behind such words: explained, so not novel.
IDENTIFIERS = (
    "username user_name password passwd secret token api_key apikey access_key access_token refresh_token client_id "
    "client_secret authorization bearer credential private_key public_key session_id signature example placeholder "
    "changeme change_me your_token_here your_api_key_here my_secret_password replace_with_your_own undefined null none "
    "http https www mail example.com example.org localhost index.html true false default string integer boolean config settings environment process.env os.environ getenv "
    "0123456789abcdefABCDEF 1234567890 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 00000000 xxxxxxxxxxxxxxxx "
    "XXXXXXXXXXXXXXXX ................ ---------------- ================ ________________ aaaaaaaaaaaaaaaa")


@dataclass(frozen=True)
class NoveltyRule:
    """When a string in sensitive context is reported."""

    min_length: int = 16         # shorter strings are too short to tell from a word
    reach: int = 2048            # code points before the string in which the sensitive word may stand
    around: int = 2048           # code points of surrounding text in the dictionary, each side
    min_novelty: float = 0.8     # marginal bytes, against a random string of that length and alphabet


_RUN = np.zeros(256, dtype=bool)
_RUN[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"]] = True
_HEX = np.zeros(256, dtype=bool)
_HEX[[ord(c) for c in "0123456789abcdef"]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _long_runs(mask: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
    starts, ends = edges[0::2], edges[1::2]
    long = ends - starts >= least
    return starts[long], ends[long]


def _marked(n: int, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Texts that a byte range touches (a range may run over the border of two texts)."""
    out = np.zeros(n, dtype=bool)
    first = np.searchsorted(offsets, starts, side="right") - 1
    last = np.searchsorted(offsets, ends - 1, side="right") - 1
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, first, 1)
    np.add.at(step, last + 1, -1)
    out[:] = np.cumsum(step[:-1]) > 0
    return out


def _with_word(low: bytes, offsets: np.ndarray, words: tuple[str, ...], n: int) -> np.ndarray:
    at = []
    for word in words:
        key, p = word.encode(), -1
        while (p := low.find(key, p + 1)) >= 0:
            at.append((p, p + len(key)))
    if not at:
        return np.zeros(n, dtype=bool)
    spans = np.array(at, np.int64)
    return _marked(n, offsets, spans[:, 0], spans[:, 1])


def novelty(text: str, start: int, end: int, rule: NoveltyRule = NoveltyRule()) -> float:
    """Marginal compressed bytes of text[start:end], given identifiers and the text around it.

    As a share of what a random string of its length and symbols takes, which is
    at most its length.
    """
    around = text[max(0, start - rule.around):start] + "\n" + text[end:end + rule.around]
    primed = zstandard.ZstdCompressionDict((IDENTIFIERS + "\n" + around).encode(),
                                           dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    packer = zstandard.ZstdCompressor(level=19, dict_data=primed, write_content_size=False,
                                      write_checksum=False, write_dict_id=False)
    value, nothing = text[start:end].encode(), len(packer.compress(b""))
    marginal = max(0, len(packer.compress(value)) - nothing)
    allowed = len(value)
    if marginal < allowed and len(set(value)) > 1:
        allowed = min(allowed, max(1, len(packer.compress(_random(value))) - nothing))
    return marginal / max(1, allowed)


def _random(value: bytes) -> bytes:
    """A string of the length of ``value``, evenly drawn from its symbols; the same for the same."""
    symbols = sorted(set(value))
    return np.random.default_rng([len(value), *symbols]).choice(np.array(symbols, np.uint8), len(value)).tobytes()


_KEY = re.compile(r"[A-Za-z_][A-Za-z0-9_.-]*=+(?=[^=])")


def _pieces(run: str, least: int) -> list[int]:
    """Where strings begin that a run of characters may hold, in the order in which they are tried.

    What follows the name of a key, then the run itself, then what follows its
    other marks.
    """
    key = _KEY.match(run)
    begins = [key.end()] if key else []
    begins += [0, *(i + 1 for i, c in enumerate(run) if c in "=/")]
    return [i for i in dict.fromkeys(begins) if len(run) - i >= least]


def _left(start: int, end: int, taken: list[tuple[int, int]]) -> int:
    """Length of the longest piece of a range that none of the sorted ``taken`` ranges covers."""
    most = 0
    for a, b in taken:
        most = max(most, min(a, end) - start)
        start = max(start, b)
    return max(most, end - start)


def scan_text(text: str, rule: NoveltyRule = NoveltyRule()) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, novelty) of one text in code points, by start, then kind as in KINDS."""
    spans = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    out = [(kind, a, b, novelty(text, a, b, rule)) for kind, a, b in spans]
    low = text.translate({c: c + 32 for c in range(65, 91)})
    if any(w in low for w in SENSITIVE):
        taken = sorted((a, b) for _, a, b in spans)
        told = sorted({(m.start(), m.end()) for w in SENSITIVE for m in re.finditer(re.escape(w), low)})
        ends = np.array([b for _, b in told])
        for m in re.finditer(r"[A-Za-z0-9+/_.=-]{%d,}" % rule.min_length, text):
            for i in _pieces(m[0], rule.min_length):
                a, b = m.start() + i, m.end()
                behind = ((ends <= a) & (ends > a - rule.reach)).any()
                if not behind or _left(a, b, taken) < rule.min_length:
                    continue
                if (new := novelty(text, a, b, rule)) >= rule.min_novelty:
                    out.append(("novel", a, b, new))
                    break
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _scan(rule: NoveltyRule):
    def run(piece: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        column, n = piece.column("text"), piece.num_rows
        data, offsets = utf8_buffer(column)
        low = _LOWER[data].tobytes()
        wanted = _with_word(low, offsets, SENSITIVE, n) | _with_word(low, offsets, ("akia",), n)
        wanted |= _marked(n, offsets, *_long_runs(_HEX[data], 24))
        spans = [[] for _ in range(n)]
        for i in np.flatnonzero(wanted):
            spans[i] = [dict(zip(("kind", "start", "end", "novelty"), s))
                        for s in scan_text(column[int(i)].as_py() or "", rule)]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                   ("novelty", pa.float64())]))
        rest = [piece.column(k) for k, name in enumerate(piece.schema.names)]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(spans, kind)], [*piece.schema.names, "spans"])
    return run


def scan_secrets(docs: DataFrame, rule: NoveltyRule = NoveltyRule(), keep: tuple[str, ...] = ("doc_id",),
                 text_col: str = "text") -> DataFrame:
    """The columns ``keep``, the text, and ``spans`` array<struct<kind, start, end, novelty>>.

    Code points, end exclusive, ordered by start and kind.  Null and empty
    texts have no spans (a null text stays null); repeated rows each give
    their own row; other columns, whatever their names, are left out.
    """
    chosen = docs.select(*[F.col(c) for c in keep if c != text_col], F.col(text_col).alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields)
    return map_slices(chosen, _scan(rule),
                      schema + ", spans array<struct<kind: string, start: int, end: int, novelty: double>>")


def redact(spans: str = "spans", text: str = "text"):
    """Column: the text with every span replaced by ``[kind]`` (overlapping spans as one, named by the first)."""
    return F.expr(f"""
        aggregate(array_sort({spans}, (x, y) -> case when x.start <> y.start then x.start - y.start
                                                   else y.end - x.end end),
                  named_struct('out', '', 'at', 0),
                  (acc, s) -> if(s.start < acc.at,
                                 named_struct('out', acc.out, 'at', greatest(acc.at, s.end)),
                                 named_struct('out', concat(acc.out, substring({text}, acc.at + 1, s.start - acc.at),
                                                            '[', s.kind, ']'), 'at', s.end)),
                  acc -> concat(acc.out, substring({text}, acc.at + 1, length({text}) - acc.at)))""")
