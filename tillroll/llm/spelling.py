"""Spelling variants: each frequent word's near words, found through Bloom filters.

1. The words of all texts are counted in Spark.
2. Every word sets six bits within one 512-bit block of a Bloom filter; the
   blocks are sharded by word length.  Spark adds the bits up as bitmaps.
3. Each word's edits (one letter deleted, one replaced by a higher letter) are
   generated and probed in the filter of their length, in numpy: an edited
   word's hash is the word's hash less and plus a few terms, so no edit is
   spelled out.  An inserted letter is a deleted one seen from the other
   word, a lower letter a higher one.
4. Only hits are shuffled: they meet the vocabulary by hash, then both words'
   spellings are compared, which removes what only the filter or the hash
   took for a word.

The filter is broadcast in portions of at most ``FILTER_BYTES``: a larger
vocabulary takes several passes, each over a range of blocks, with the same
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.bloom import BITS_PER_KEY, BLOCK_BITS, FILTER_BYTES, PER_MAP, bitmaps, hits, key_bits, place, portion
from tillroll.llm.frames import ship_package, signed, write_scratch
from tillroll.llm.words import mix

LETTERS = r"[A-Za-zÀ-ÿ]"
ALPHABET = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint8)
LONGEST = 255                    # words of more letters share one shard
EDITS_AT_ONCE = 1 << 19

_U = np.uint64


def counted_words(docs: DataFrame, seed_parts: int = 199, shortest: int = 6, least: int = 5) -> DataFrame:
    """word, n: runs of letters, every ``seed_parts``-th (by crc32 of id and run) with a letter deleted."""
    upper, lower = (bytes(range(a, a + 26)).decode() for a in (65, 97))
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{shortest},}}"), F.lit(0))).alias("run"))
    runs = runs.withColumn("run", F.translate("run", upper, lower)) \
        .withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = runs.select(F.when(F.col("h") % seed_parts == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n")) \
        .filter(F.col("n") >= least)


def _letters(place: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """What a letter at a place adds to a word's hash."""
    return mix((place.astype(_U) << _U(8)) + letter.astype(_U) + _U(1))


def _key(sums: np.ndarray, length: int) -> np.ndarray:
    return mix(sums + _U(length * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF))


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, indices, letters as a matrix) of equally long words; every letter is one Latin-1 byte."""
    coded = [w.encode("latin-1") for w in words]
    sizes = np.array([len(c) for c in coded])
    for length in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == length)
        step = max(1, (8 << 20) // (8 * length))
        for low in range(0, len(at), step):
            some = at[low:low + step]
            yield length, some, np.frombuffer(b"".join(coded[i] for i in some), np.uint8).reshape(-1, length)


def _word_keys(words: list[str]) -> np.ndarray:
    keys = np.zeros(len(words), dtype=_U)
    for length, at, letters in _by_length(words):
        keys[at] = _key(_letters(np.arange(length), letters).sum(axis=1, dtype=_U), length)
    return keys


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.append_column("key", pa.array(signed(_word_keys(batch.column("word").to_pylist()))))


class Shards:
    """Where in the filter the words of each length lie."""

    def __init__(self, counts: dict[int, int], bits: int = BITS_PER_KEY):
        sizes = np.zeros(LONGEST + 1, np.int64)
        for shard, n in counts.items():
            sizes[shard] = -(-n * bits // BLOCK_BITS)
        self.size = sizes.astype(_U)
        self.base = (np.cumsum(sizes) - sizes).astype(_U)
        self.blocks = int(sizes.sum())

    def block(self, keys: np.ndarray, length: int) -> np.ndarray:
        shard = min(length, LONGEST)
        return (self.base[shard] + place(keys, self.size[shard])).astype(np.int64)


def _set_bits(shards: Shards):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy().view(_U)
            sizes = batch.column("length").to_numpy()
            where = np.zeros(len(keys), np.int64)
            for length in np.unique(sizes).tolist():
                mine = sizes == length
                where[mine] = shards.block(keys[mine], length)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key_bits(keys, where))], ["bit"])
    return run


def _edits(letters: np.ndarray, key_sums: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, row, place, letter, key) of the edits of equally long words; letter 0: deleted."""
    n, length = letters.shape
    place = np.arange(length)
    here = _letters(place, letters)
    # Without the letter at i, what follows stands one place earlier.
    moved = np.cumsum(_letters(place[1:] - 1, letters[:, 1:])[:, ::-1], axis=1, dtype=_U)[:, ::-1]
    moved = np.concatenate([moved, np.zeros((n, 1), _U)], axis=1)
    before = np.cumsum(here, axis=1, dtype=_U) - here
    first_of_run = np.ones(letters.shape, dtype=bool)           # equal letters in a row: one deletion stands for all
    first_of_run[:, 1:] = letters[:, 1:] != letters[:, :-1]
    row, at = np.nonzero(first_of_run)
    yield length - 1, row, at, np.zeros(len(row), np.uint8), _key((before + moved)[row, at], length - 1)
    wide = max(1, EDITS_AT_ONCE // (n * len(ALPHABET)))
    for low in range(0, length, wide):
        part = letters[:, low:low + wide]
        new = _letters(place[low:low + wide, None], ALPHABET[None, :])
        row, at, to = np.nonzero(ALPHABET[None, None, :] > part[:, :, None])
        sums = key_sums[row] - here[row, low + at] + new[at, to]
        yield length, row, low + at, ALPHABET[to], _key(sums, length)


def _probe(shards: Shards, low: int, high: int, filter_words):
    """Edits that the filter blocks ``low`` to ``high`` may hold: key, other, place, letter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(filter_words.value, _U)
        for batch in batches:
            words = batch.column("word").to_pylist()
            own = batch.column("key").to_numpy()
            for length, at, letters in _by_length(words):
                step = max(1, EDITS_AT_ONCE // (length * len(ALPHABET)))
                for k in range(0, len(at), step):
                    some = letters[k:k + step]
                    sums = _letters(np.arange(length), some).sum(axis=1, dtype=_U)
                    for size, row, place, letter, key in _edits(some, sums):
                        if not shards.size[min(size, LONGEST)]:
                            continue
                        block = shards.block(key, size)
                        hit = np.flatnonzero((block >= low) & (block < high))
                        hit = hit[hits(bits, key[hit], block[hit] - low)]
                        if len(hit):
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(own[at[k + row[hit]]]), pa.array(signed(key[hit])),
                                 pa.array(place[hit].astype(np.int32)), pa.array(letter[hit].astype(np.int32))],
                                ["key", "other_key", "place", "letter"])
    return run


def _hits(vocabulary: DataFrame, filter_bytes: int) -> DataFrame:
    """Edits of all words that pass the filter; false ones are still among them."""
    spark = vocabulary.sparkSession
    shard = F.least("length", F.lit(LONGEST))
    shards = Shards({r.shard: r.n for r in vocabulary.groupBy(shard.alias("shard"))
                    .agg(F.count(F.lit(1)).alias("n")).collect()})          # one row a shard, 250 at most
    set_bits = vocabulary.select("key", "length").mapInArrow(_set_bits(shards), "bit long")
    maps = write_scratch(bitmaps(set_bits), "filter")
    n_maps = -(-shards.blocks // PER_MAP)
    at_once = max(1, filter_bytes // (PER_MAP * BLOCK_BITS // 8))            # bitmaps of one pass
    found = None
    for first in range(0, n_maps, at_once):
        held = spark.sparkContext.broadcast(portion(maps, first, min(at_once, n_maps - first)))
        some = vocabulary.select("word", "key").mapInArrow(
            _probe(shards, first * PER_MAP, (first + at_once) * PER_MAP, held),
            "key long, other_key long, place int, letter int")
        found = some if found is None else found.unionByName(some)
    return found


def _edited(word: Column, place: Column, letter: Column) -> Column:
    new = F.when(letter == 0, "").otherwise(F.decode(F.unhex(F.lpad(F.hex(letter), 2, "0")), "ISO-8859-1"))
    return F.concat(F.substr(word, F.lit(1), place), new, F.substr(word, place + 2))


def near_pairs(vocabulary: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """word, n, other, other_n: each two near words once; ``vocabulary`` has word, n, key and length."""
    hits = _hits(vocabulary, filter_bytes)
    if hits is None:
        return vocabulary.sparkSession.createDataFrame([], "word string, n long, other string, other_n long")
    ours = vocabulary.select("key", "word", "n")
    theirs = vocabulary.select(F.col("key").alias("other_key"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    return hits.join(theirs, "other_key").join(ours, "key") \
        .filter(_edited(F.col("word"), F.col("place"), F.col("letter")) == F.col("other")) \
        .select("word", "n", "other", "other_n")


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last word that following (word, form) from each word leads to.

    Every round doubles the steps taken; a form's n is several times its
    word's, so chains are short and have no loops.
    """
    now = write_scratch(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        then = write_scratch(now.join(on, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        if not then.filter("moved").limit(1).count():
            return then.select("word", "root")
        now = then.select("word", "root")


def spelling_variants(docs: DataFrame, ratio: int = 5, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """word, form, root, n, n_near, form_n of every frequent word.

    Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` of whole texts, only
    A-Z lower-cased.  Where 199 divides ``h = crc32("<doc_id>:<run>")``, the
    code point ``h % length`` of the run is deleted.  Kept are words of 6 code
    points and 5 occurrences (``n``) or more.  Two words are near if one
    inserted, deleted or replaced code point makes one of the other;
    ``n_near`` counts near words.  ``form`` is the near word of largest n
    (ties: the smallest in code-point order) if that is at least ``ratio``
    times the word's own n, else null; ``root`` is where following forms ends.

    Null and empty texts have no words; a null doc_id counts as the empty
    text; repeated rows count as often as they stand there.  Words of any
    length take part.  Other columns are ignored; an empty table, or one
    without frequent words, gives no rows.
    """
    ship_package(docs.sparkSession)
    counted = counted_words(docs.select("doc_id", "text")).withColumn("length", F.length("word"))
    vocabulary = write_scratch(counted.mapInArrow(_keyed, "word string, n long, length int, key long"), "vocabulary")
    pairs = write_scratch(near_pairs(vocabulary, filter_bytes), "near")
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"),
                                          F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.first("n").alias("own"),
        F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best"))
    chosen = -F.col("best.less") >= F.col("own") * ratio
    near = write_scratch(best.select("word", "n_near", F.when(chosen, F.col("best.form")).alias("form"),
                                     F.when(chosen, -F.col("best.less")).alias("form_n")), "forms")
    ends = roots(near.filter("form is not null"))
    return vocabulary.join(near, "word", "left").join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


ORACLE = r"""
WITH RECURSIVE bits AS (
  SELECT CAST(i AS BIGINT) AS i, CAST(i AS BIGINT) AS v, 0 AS k FROM range(256) r(i)
  UNION ALL
  SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
steps AS (SELECT i, v FROM bits WHERE k = 8),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
keyed AS (
  SELECT row_number() OVER () AS k, run, n, hex(encode(id || ':' || run)) AS hx
  FROM (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY id, run)),
crc AS (
  SELECT k, hx, 1 AS p, CAST(4294967295 AS BIGINT) AS c FROM keyed
  UNION ALL
  SELECT k, hx, p + 2, xor(c >> 8, s.v)
  FROM crc JOIN steps s ON s.i = xor(c, CAST('0x' || substr(hx, p, 2) AS BIGINT)) & 255 WHERE p < length(hx)),
hashed AS (
  SELECT run, n, xor(c, 4294967295) AS h FROM keyed JOIN (SELECT k, c FROM crc WHERE p > length(hx)) USING (k)),
spelled AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
         n FROM hashed),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelled WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS (
  SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM v)),
deleted AS (SELECT DISTINCT c.word AS a, v.word AS b FROM cuts c JOIN v ON v.word = c.rest),
replaced AS (SELECT DISTINCT x.word AS a, y.word AS b FROM cuts x JOIN cuts y ON x.rest = y.rest AND x.p = y.p AND x.word <> y.word),
near AS (SELECT a, b FROM deleted UNION SELECT b, a FROM deleted UNION SELECT a, b FROM replaced),
ranked AS (
  SELECT near.a AS word, near.b AS other, o.n AS other_n, count(*) OVER (PARTITION BY near.a) AS n_near,
         row_number() OVER (PARTITION BY near.a ORDER BY o.n DESC, encode(near.b)) AS r
  FROM near JOIN v o ON o.word = near.b),
forms AS (
  SELECT v.word, v.n, CAST(coalesce(r.n_near, 0) AS BIGINT) AS n_near,
         CASE WHEN r.other_n >= 5 * v.n THEN r.other END AS form, CASE WHEN r.other_n >= 5 * v.n THEN r.other_n END AS form_n
  FROM v LEFT JOIN ranked r ON r.word = v.word AND r.r = 1),
walk AS (
  SELECT word, word AS at, form AS next FROM forms
  UNION ALL
  SELECT w.word, f.word, f.form FROM walk w JOIN forms f ON f.word = w.next)
SELECT f.word, f.form, w.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN walk w ON w.word = f.word AND w.next IS NULL
"""
