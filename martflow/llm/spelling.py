"""Spelling variants: words one edit apart, found by a reduced alphabet, and their forms.

Two words are near when one inserted, deleted or replaced code point turns one into the
other. Letters are hashed to a few symbols, and a word's symbols are its reduced word. An
edit of a word edits its reduced word in one place or leaves it as it is. So all near
words of a word are found among the words whose reduced word lies in the full one-edit
neighbourhood of its own:

1. the distinct reduced words generate their neighbourhoods (itself, all deletions,
   replacements and insertions of a symbol), as 64-bit keys;
2. these meet the reduced vocabulary, which leaves pairs of reduced words;
3. the words of each pair are compared as they are; that test is the join's condition, so
   only near words leave it.

The alphabet grows with the vocabulary (:func:`symbols_for`), so that a reduced word stands
for few words at any size; it doesn't change the result. Counts are summed per task before
they meet, so a very frequent word is a row per task.

Defined cases: null and empty texts have no words; a null id counts as empty text in the
misspelling rule; texts are read whole; repeated rows count each; an empty table gives no
rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_small, mix, read_table, save

RUN = "[A-Za-zÀ-ÿ]+"
MIN_LETTERS, MIN_COUNT = 5, 3
RATIO = 2           # a form has at least this many times the word's occurrences
DROP_ONE_IN = 97    # of the (document, run) pairs, one in so many loses a code point
_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEYS = 2_000_000    # of 8 bytes: reduced vocabularies up to this size are broadcast


# ---------------------------------------------------------------- words

def lowered(run: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    ascii_only = F.octet_length(run) == F.char_length(run)
    return F.when(ascii_only, F.lower(run)).otherwise(F.translate(run, _UPPER, _SMALL))


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, run``: every letter run of every text, lower-cased."""
    found = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                        F.explode(F.regexp_extract_all(F.col(text_col), F.lit(RUN), F.lit(0))).alias("run"))
    return found.select("id", lowered(F.col("run")).alias("run"))


def misspelt(found: DataFrame) -> DataFrame:
    """``word``: the runs, of which one in ``DROP_ONE_IN`` (document, run) pairs lose a letter."""
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = F.pmod(h, F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    return found.select(F.when(F.pmod(h, F.lit(DROP_ONE_IN)) == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of the long enough and frequent enough words."""
    return (words.where(F.char_length("word") >= min_letters)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count))


# ---------------------------------------------------------------- reduced words

def symbols_for(size: int) -> int:
    """Symbols of the alphabet: about as many reduced words of eight letters as words."""
    return int(min(64, max(4, np.ceil(max(size, 1) ** 0.125))))


_BASE = 0x9E3779B97F4A7C15      # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))


def _letters(words: list[str], symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """The words' symbols, 1 to ``symbols``, one after another, and the words' lengths."""
    joined = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    return mix(joined, 7) % np.uint64(symbols) + np.uint64(1), np.array([len(w) for w in words], dtype=np.int64)


def _places(letters: np.ndarray, lengths: np.ndarray):
    """Per letter: its word, its place in it, and that place's power of the base."""
    first = np.cumsum(lengths) - lengths
    word = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(letters)) - first[word]
    power = np.ones(int(lengths.max(initial=0)) + 2, dtype=np.uint64)
    power[1:] = np.cumprod(np.full(len(power) - 1, _BASE, dtype=np.uint64))
    return first, word, place, power


def reduced_keys(words: list[str], symbols: int) -> np.ndarray:
    """A 64-bit key of each reduced word: the sum of symbol times base to the place."""
    letters, lengths = _letters(words, symbols)
    first, word, place, power = _places(letters, lengths)
    sums = np.zeros(len(letters) + 1, dtype=np.uint64)
    np.cumsum(letters * power[place], out=sums[1:])
    return sums[first + lengths] - sums[first]


def neighbourhoods(words: list[str], symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of word, key) of the whole one-edit neighbourhood of each reduced word, each
    key once for a word."""
    letters, lengths = _letters(words, symbols)
    first, word, place, power = _places(letters, lengths)
    sums = np.zeros(len(letters) + 1, dtype=np.uint64)
    np.cumsum(letters * power[place], out=sums[1:])
    whole = sums[first + lengths] - sums[first]
    before = sums[:-1] - sums[first[word]]                      # letters left of each place
    after = whole[word] - before - letters * power[place]       # and right of it
    owners, keys = [np.arange(len(words)), word], [whole, before + after * _INVERSE]
    # the place behind the last letter takes insertions too
    gap_word = np.concatenate([word, np.arange(len(words))])
    gap_power = power[np.concatenate([place, lengths])]
    gap_before = np.concatenate([before, whole])
    gap_after = np.concatenate([after + letters * power[place], np.zeros(len(words), np.uint64)])
    for s in range(1, symbols + 1):
        new = letters != s
        owners += [word[new], gap_word]
        keys += [(before + after + np.uint64(s) * power[place])[new],
                 gap_before + np.uint64(s) * gap_power + gap_after * np.uint64(_BASE)]
    owner, key = np.concatenate(owners), np.concatenate(keys)
    order = np.lexsort((key, owner))
    owner, key = owner[order], key[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])
    return owner[new], key[new]


_CHUNK = 4096       # words whose neighbourhoods are in memory at a time


def _with_keys(words: DataFrame, symbols: int) -> DataFrame:
    """``word, n, reduced``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = reduced_keys(batch.column(0).to_pylist(), symbols).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys)], ["word", "n", "reduced"])
    return words.select("word", "n").mapInArrow(run, "word string, n long, reduced long")


def _neighbours(one_each: DataFrame, symbols: int) -> DataFrame:
    """``reduced, near_key`` from a word for each reduced word (``reduced, word``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _CHUNK):
                part = batch.slice(at, _CHUNK)
                owner, key = neighbourhoods(part.column(1).to_pylist(), symbols)
                own = part.column(0).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array(own[owner]), pa.array(key.view(np.int64))],
                                                 ["reduced", "near_key"])
    return one_each.select("reduced", "word").mapInArrow(run, "reduced long, near_key long")


def near_words(words: DataFrame, symbols: int | None = None) -> DataFrame:
    """``word, n, near, near_n``: all ordered pairs of words one edit apart, from the
    distinct words of ``word, n``."""
    words = save(words, "spelling-words")
    symbols = symbols or symbols_for(words.count())
    keyed = save(_with_keys(words, symbols), "spelling-keys")
    one_each = keyed.groupBy("reduced").agg(F.min("word").alias("word"))
    known = save(keyed.select(F.col("reduced").alias("near_key")).distinct(), "spelling-reduced")
    pairs = save(_neighbours(one_each, symbols).join(broadcast_if_small(known, KEYS), "near_key", "left_semi"),
                 "spelling-pairs")
    left = keyed.join(pairs, "reduced").select("word", "n", "near_key")
    right = keyed.select(F.col("reduced").alias("near_key"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    # the comparison is the join's condition: candidates that fail it are no rows
    return (left.join(right, (left.near_key == right.near_key) & (F.levenshtein("word", "near", 1) == 1))
            .select("word", "n", "near", "near_n"))


def variants(words: DataFrame, ratio: int = RATIO, symbols: int | None = None) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of each word of ``word, n``."""
    words = save(words, "spelling-vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    found = near_words(words, symbols).groupBy(F.col("word").alias("of")).agg(
        F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    shaped = words.join(found, F.col("word") == F.col("of"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
    has_form = F.col("near_n") >= ratio * F.col("n")
    shaped = save(shaped.select("word", "n", "n_near", F.when(has_form, F.col("near")).alias("form"),
                                F.when(has_form, F.col("near_n")).alias("form_n")), "spelling-forms")
    roots = _roots(shaped.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return (shaped.join(broadcast_if_small(roots.withColumnsRenamed({"word": "of"})), F.col("word") == F.col("of"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def _roots(links: DataFrame) -> DataFrame:
    """Follow ``word -> root`` links to their ends, doubling the step each time; a form has
    at least ``ratio`` times its word's count, so chains are short and have no cycles."""
    links = save(links, "spelling-links")
    while True:
        on = broadcast_if_small(links.select(F.col("word").alias("mid"), F.col("root").alias("next")))
        links = save(links.join(on, F.col("root") == F.col("mid"), "left")
                     .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                     "spelling-links")
        if links.where("moved").isEmpty():
            return links.drop("moved")
        links = links.drop("moved")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = vocabulary(misspelt(runs(read_table(spark, sf_dir, "documents"))))
    return variants(words).select("word", "form", "root", "n", "n_near", "form_n")


OP13_SQL = r"""
WITH RECURSIVE found AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id,
         unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS raw FROM documents),
runs AS (
  SELECT id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM found GROUP BY ALL),
hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, strlen(id || ':' || run) + 1),
                 lambda k: ('0x' || substr(hex(encode(id || ':' || run)), 2 * k - 1, 2))::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                             lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) AS h FROM runs),
spelt AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cuts AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b
    ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, min(other) FILTER (WHERE other_n = most) AS other, max(most) AS other_n
  FROM (SELECT *, max(other_n) OVER (PARTITION BY word) AS most FROM near) GROUP BY word),
shaped AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near,
         CASE WHEN b.other_n >= 2 * w.n THEN b.other END AS form, CASE WHEN b.other_n >= 2 * w.n THEN b.other_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
walk AS (
  SELECT word, word AS root, form AS next FROM shaped
  UNION ALL SELECT walk.word, s.word, s.form FROM walk JOIN shaped s ON s.word = walk.next)
SELECT s.word, s.form, walk.root, s.n, s.n_near, s.form_n
FROM shaped s JOIN walk ON walk.word = s.word AND walk.next IS NULL
"""
