"""Quality rules: base counts, and the divergence of a text from language references.

For every text two histograms are made, over character classes and over common words,
and compared with references of each language by Jensen-Shannon distance (base 2, 0 to
1). The references are summed over all documents of the language that pass the base
rules, so they follow the corpus. A language needs ``MIN_SUPPORT`` such documents to have
one; documents of other languages are judged by the references that there are. A text is
kept when one reference, without the text's own counts, is near in both histograms; so
one language judges, and no text is its own norm. The word test needs ``MIN_WORDS`` words
and the class test ``MIN_CHARS`` characters; shorter texts are only subject to the base
rules. The distances returned are the smallest over the references, each for itself.

Character classes are read from UTF-8 lead bytes, so they need no decoding: small and
capital ASCII letters, digits, sentence punctuation, the symbols of the base rule, other
ASCII punctuation, white space, Latin letters beyond ASCII, letters of other scripts,
other characters. Common words are those whose hashed bucket is among a language's
``TOP_WORDS`` most frequent of ``BUCKETS``; all other words are one further class. With
that, the reference of a language has a fixed size whatever the corpus.

Defined cases: a null or empty text has zero counts and fails the base rules (fewer than
20 words). Without any language of enough documents there is no reference, and the
verdict is that of the base rules. Documents with null language don't
enter the references but are judged like others. Repeated rows are each judged; extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, bounded_batches, chunks, map_texts, mix, read_table, span_hashes, window_hashes

MIN_BASE_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30
CLASSES = 10
BUCKETS = 4096
TOP_WORDS = 64
MIN_SUPPORT = 10           # documents of a language that pass the base rules
MIN_WORDS = 40
MIN_CHARS = 300
MAX_CLASS_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.50


def _class_table() -> np.ndarray:
    """Class of each byte; 255 for the continuation bytes of a character."""
    table = np.full(256, 5, dtype=np.uint8)           # other ASCII punctuation
    table[ord("a"):ord("z") + 1] = 0
    table[ord("A"):ord("Z") + 1] = 1
    table[ord("0"):ord("9") + 1] = 2
    table[[ord(c) for c in ".,;:!?'\"()-"]] = 3
    table[[ord(c) for c in "#*$%&|<>"]] = 4
    table[:33] = 6                                    # space and controls
    table[0x80:0xC0] = 255
    table[0xC3:0xC9] = 7                              # Latin letters beyond ASCII
    table[0xC9:0xE2] = 8                              # other scripts
    table[0xE3:0xEE] = 8
    table[[0xC0, 0xC1, 0xC2, 0xE2, 0xEE, 0xEF]] = 9
    table[0xF0:] = 9
    return table


CLASS_OF = _class_table()
_SYMBOL = np.isin(np.arange(256), [ord(c) for c in "#*$%&|<>"])


def _repeat_words(words: Words, h: np.ndarray) -> np.ndarray:
    """Per text, the words inside 8-word windows that occur twice or more in it."""
    valid = np.flatnonzero(words.left() >= REPEAT_WINDOW)
    covered = np.zeros(len(h) + 1, dtype=np.int32)
    if len(valid):
        doc = words.doc_of_word()[valid].astype(np.uint64)
        key = window_hashes(h, REPEAT_WINDOW)[valid] ^ mix(doc, 3)   # equal only within one text
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        same = np.zeros(len(ranked) + 1, dtype=bool)
        same[1:-1] = ranked[1:] == ranked[:-1]
        hit = valid[order[same[1:] | same[:-1]]]
        np.add.at(covered, hit, 1)
        np.add.at(covered, hit + REPEAT_WINDOW, -1)
    inside = np.concatenate([[0], np.cumsum(np.cumsum(covered[:-1]) > 0)])
    return inside[words.first[1:]] - inside[words.first[:-1]]


def _dup_lines(words: Words) -> np.ndarray:
    """Per text, the lines with a word that equal an earlier line of it."""
    ends = np.flatnonzero(words.data == 0x0A)         # texts end with a line feed of their own
    starts = np.concatenate([[0], ends[:-1] + 1])
    with_word = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[with_word], ends[with_word]
    doc = np.searchsorted(words.offsets, starts, side="right") - 1
    key = span_hashes(words.data, starts, ends) ^ mix(doc.astype(np.uint64), 4)
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), dtype=bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    return np.bincount(doc[again], minlength=len(words.counts))


def _class_counts(words: Words) -> np.ndarray:
    """Per text and class, its characters (the separator after each text excluded)."""
    kind = CLASS_OF[words.data]
    kind[words.offsets[1:] - 1] = 255
    out = np.empty((len(words.counts), CLASSES), dtype=np.int64)
    for k in range(CLASSES):
        out[:, k] = np.add.reduceat(kind == k, words.offsets[:-1], dtype=np.int64)
    return out


def measure(texts: list[bytes]) -> dict:
    """Base counts, class histogram and hashed word buckets of each text."""
    words = Words(texts)
    h = words.hashes()
    chars = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    in_word = np.concatenate([[0], np.cumsum(chars[words.ends] - chars[words.starts])])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[words.data])])
    repeats = _repeat_words(words, h)
    n = words.counts
    return {
        "n_words": n, "word_chars": in_word[words.first[1:]] - in_word[words.first[:-1]],
        "n_symbols": symbols[words.offsets[1:]] - symbols[words.offsets[:-1]],
        "n_dup_lines": _dup_lines(words), "n_repeat_words": repeats,
        "base_failed": (n < MIN_BASE_WORDS) | (100 * repeats > REPEAT_PERCENT * n),
        "classes": _class_counts(words),
        "buckets": (words.hashes(lower=True) % np.uint64(BUCKETS)).astype(np.int64), "words": words,
    }


def references(docs: DataFrame, text_col: str, lang_col: str) -> dict:
    """{lang: (class counts, word bucket counts)} over all documents that have a language
    and pass the base rules, for languages with ``MIN_SUPPORT`` of these. Each task adds up fixed-size vectors per language; Spark sums
    them, so the driver gets one pair of vectors per language."""
    schema = "lang string, slot int, n long"

    def add(batches):
        sums: dict = {}
        for batch, texts in chunks(batches, "text"):
            m = measure(texts)
            langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
            which = np.array([x is not None for x in langs]) & ~m["base_failed"]
            doc = m["words"].doc_of_word()
            for lang in {x for x, ok in zip(langs, which) if ok}:
                own = which & np.array([x == lang for x in langs])
                total = sums.setdefault(lang, np.zeros(CLASSES + BUCKETS + 1, dtype=np.int64))
                total[-1] += own.sum()
                total[:CLASSES] += m["classes"][own].sum(axis=0)
                total[CLASSES:-1] += np.bincount(m["buckets"][own[doc]], minlength=BUCKETS)
        for lang, total in sums.items():
            slots = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(slots), pa.string()), pa.array(slots, pa.int32()), pa.array(total[slots])],
                ["lang", "slot", "n"])

    rows = bounded_batches(docs).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")) \
        .mapInArrow(add, schema).groupBy("lang", "slot").agg(F.sum("n").alias("n")).collect()
    out: dict = {}
    for lang, slot, n in rows:
        out.setdefault(lang, np.zeros(CLASSES + BUCKETS + 1))[slot] = n
    return {lang: (v[:CLASSES], v[CLASSES:-1]) for lang, v in sorted(out.items()) if v[-1] >= MIN_SUPPORT}


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Square root of the Jensen-Shannon divergence (base 2) of each row of ``p`` from ``q``,
    one histogram or one for each row."""
    p = p / np.maximum(p.sum(axis=1, keepdims=True), 1)
    q = q / np.maximum(q.sum(axis=-1, keepdims=True), 1)
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / middle), 0).sum(axis=1)
        b = np.where(q > 0, q * np.log2(q / middle), 0).sum(axis=1)
    return np.sqrt(np.clip((a + b) / 2, 0, 1))


class Judge:
    """Distances of texts from the references, and the verdict by them."""

    def __init__(self, refs: dict):
        self.refs = []
        for lang, (classes, buckets) in refs.items():
            top = np.argsort(-buckets, kind="stable")[:TOP_WORDS]
            place = np.full(BUCKETS, TOP_WORDS, dtype=np.int64)
            place[top] = np.arange(TOP_WORDS)
            self.refs.append((lang, classes, np.append(buckets[top], buckets.sum() - buckets[top].sum()), place))

    def judge(self, m: dict, langs: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The smallest class and word distances, and which texts no reference accepts.
        ``langs`` are the texts' languages: the reference of its own judges a text without
        the counts that it put there."""
        n = len(m["n_words"])
        by_class, by_word, accepted = np.ones(n), np.ones(n), np.zeros(n, dtype=bool)
        doc = m["words"].doc_of_word() * (TOP_WORDS + 1)
        long, wordy = m["classes"].sum(axis=1) >= MIN_CHARS, m["n_words"] >= MIN_WORDS
        for lang, classes, common, place in self.refs:
            counts = np.bincount(doc + place[m["buckets"]], minlength=n * (TOP_WORDS + 1)).reshape(n, TOP_WORDS + 1)
            c, w = js_distance(m["classes"], classes), js_distance(counts, common)
            by_class, by_word = np.minimum(by_class, c), np.minimum(by_word, w)
            own = np.flatnonzero(np.array([x == lang for x in langs], dtype=bool) & ~m["base_failed"])
            if len(own):
                c[own] = js_distance(m["classes"][own], classes - m["classes"][own])
                w[own] = js_distance(counts[own], common - counts[own])
            accepted |= ~(long & (c > MAX_CLASS_DISTANCE)) & ~(wordy & (w > MAX_WORD_DISTANCE))
        return by_class, by_word, ~accepted if self.refs else accepted


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang", refs: dict | None = None) -> DataFrame:
    """Rows (doc_id, the five counts, base_failed, kept, class_distance, word_distance)."""
    refs = references(docs, text_col, lang_col) if refs is None else refs
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) \
        + ", base_failed boolean, kept boolean, class_distance double, word_distance double"
    names = ["doc_id", *COUNTS, "base_failed", "kept", "class_distance", "word_distance"]

    def make():
        judge = Judge(refs)

        def f(batch, texts):
            m = measure(texts)
            by_class, by_word, rejected = judge.judge(m, batch.column(2).to_pylist())
            kept = ~(m["base_failed"] | rejected)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(m[c].astype(np.int64)) for c in COUNTS), pa.array(m["base_failed"]),
                 pa.array(kept), pa.array(by_class), pa.array(by_word)], names)
        return f
    return map_texts(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                                 F.col(lang_col).cast("string").alias("lang")), "text", make, schema)


def keep_rows(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without the rows that the rules reject, all columns as they were. The
    verdict is made where the row is, so no join is needed."""
    refs = references(docs, text_col, lang_col)

    def run(batches):
        judge = Judge(refs)
        for batch, texts in chunks(batches, text_col):
            m = measure(texts)
            langs = batch.column(batch.schema.get_field_index(lang_col)).cast(pa.string()).to_pylist()
            kept = ~(m["base_failed"] | judge.judge(m, langs)[2])
            yield batch.filter(pa.array(kept))
    return bounded_batches(docs).mapInArrow(run, docs.schema)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents"))
