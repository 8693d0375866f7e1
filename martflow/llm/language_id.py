"""Language identification by a linear-chain conditional random field over words.

Each word of a text gets a language; the text's language is the one with the largest sum
of word marginals. Emissions are sums of weights of hashed features: affixes (1 to 4
bytes), character n-grams (2 to 4 bytes, with word boundaries), the whole word, and per
language whether the word is in its lexicon (its most frequent training words). A word is
a run without ASCII white space; one longer than ``WORD_BYTES`` is cut into pieces that are
words of the chain, so every byte of an unspaced text is read.
Transitions are learned, and the marginals come from forward-backward.

Learning: a bounded sample of labelled texts (``TRAIN_TEXTS`` of each language,
``TRAIN_WORDS`` consecutive words from a seeded place of each) is cut into spans, and
spans of different languages are chained into code-switched sequences, so transitions
between languages are seen. The likelihood's gradient is exact; AdaGrad makes the steps.

Prediction reads every whole text. Long texts are cut into segments whose transfer
matrices are multiplied up first, so that the marginals are those of the whole chain
while numpy steps through all segments of many texts at once.

Defined cases: null text or a text without a letter gives ``und`` and score 0; without
any labelled text all are ``und``; with one learned language every text with a letter
gets it; ties go to the language first by code point; repeated rows are predicted each;
null ids count as not held out; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_texts, mix, read_table

TRAIN_TEXTS = 500         # of each language
TRAIN_WORDS = 100         # of each of these texts
MAX_LANGUAGES = 64
LEXICON = 300             # words of each language
SLOTS_LOG2 = 18           # of the hashed feature weights
WORD_BYTES = 24           # longer words are cut into pieces of at most so many
AFTER, GOES_ON = b"\xfe", b"\xff"     # marks of cut words; no bytes of UTF-8
_PUNCTUATION = b".,;:!?\"'()[]{}|#*$%&<>+-=/"
SPAN = (4, 24)            # words of one language in a code-switched training sequence
TRAIN_STEPS = 30
LENGTH = 64               # words of a segment
CACHE_WORDS = 400_000     # distinct words kept per worker


# ---------------------------------------------------------------------------
# Features

def pieces(words: list[bytes]) -> list[bytes]:
    """Words longer than ``WORD_BYTES`` cut at characters into pieces of at most that; ``AFTER``
    and ``GOES_ON`` mark where a piece was cut. Pieces stay as they are."""
    if not words or len(max(words, key=len)) <= WORD_BYTES:
        return words
    out = []
    for w in words:
        if len(w) > WORD_BYTES and not (w.startswith(AFTER) or w.endswith(GOES_ON)):
            w = w.strip(_PUNCTUATION) or w
            at, n = 0, len(w)
            while n - at > WORD_BYTES:
                to = at + WORD_BYTES
                while w[to] & 0xC0 == 0x80:
                    to -= 1
                out.append((AFTER if at else b"") + w[at:to] + GOES_ON)
                at = to
            out.append((AFTER if at else b"") + w[at:])
        else:
            out.append(w)
    return out


def _feature_slots(words: list[bytes]) -> np.ndarray:
    """(words, features) slots of the hashed weights; -1 where a word is too short. A cut end of
    a piece has a mark of its own, and no prefix or suffix."""
    n = len(words)
    cut_before = np.array([w.startswith(AFTER) for w in words], dtype=bool)
    cut_behind = np.array([w.endswith(GOES_ON) for w in words], dtype=bool)
    words = [w.strip(AFTER + GOES_ON) for w in words]
    head = np.zeros((n, WORD_BYTES + 2), dtype=np.uint64)
    raw = np.array([w[:WORD_BYTES] for w in words], dtype=f"S{WORD_BYTES}")
    head[:, 1:-1] = raw.view(np.uint8).reshape(n, WORD_BYTES)
    length = np.array([min(len(w), WORD_BYTES) for w in words])
    head[:, 0] = np.where(cut_before, 258, 256)
    head[np.arange(n), length + 1] = np.where(cut_behind, 259, 257)
    tail = np.array([w[-4:].rjust(4, b"\0") for w in words], dtype="S4")
    tail = np.frombuffer(tail.tobytes().ljust(4 * n, b"\0"), np.uint8).reshape(n, 4).astype(np.uint64)
    whole = np.zeros(n, dtype=np.uint64)
    for k in range(WORD_BYTES + 2):
        whole = whole * np.uint64(1_000_003) + head[:, k]
    found = [mix(whole, 1)[:, None]]
    prefix, suffix = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    for k in range(4):
        prefix = prefix * np.uint64(521) + head[:, k + 1] + np.uint64(1)
        suffix = suffix * np.uint64(521) + tail[:, 3 - k] + np.uint64(1)
        found += [mix(prefix, 10 + k)[:, None], mix(suffix, 20 + k)[:, None]]
    width = WORD_BYTES + 2
    used = [np.ones((n, 9), dtype=bool)]
    used[0][cut_before, 1::2] = False
    used[0][cut_behind, 2::2] = False
    for size in (2, 3, 4):
        gram = np.zeros((n, width - size + 1), dtype=np.uint64)
        for k in range(size):
            gram = gram * np.uint64(521) + head[:, k:width - size + 1 + k]
        found.append(mix(gram, 30 + size))
        used.append(np.arange(width - size + 1)[None, :] + size <= (length + 2)[:, None])
    slots = (np.concatenate(found, axis=1) >> np.uint64(64 - SLOTS_LOG2)).astype(np.int64)
    slots[~np.concatenate(used, axis=1)] = -1
    return slots


def normal(words: list[bytes]) -> list[bytes]:
    return [w.strip(_PUNCTUATION).lower() for w in words]


class Model:
    """Languages, hashed weights, lexicon weights and transitions."""

    def __init__(self, langs, weights, lexicon, lexicon_weights, start, transitions):
        self.langs, self.weights, self.lexicon = langs, weights, lexicon
        self.lexicon_weights, self.start, self.transitions = lexicon_weights, start, transitions

    def emissions(self, words: list[bytes]) -> np.ndarray:
        """(words, languages) scores."""
        slots = _feature_slots(words)
        padded = np.concatenate([self.weights, np.zeros((1, len(self.langs)), np.float32)])
        out = np.zeros((len(words), len(self.langs)), dtype=np.float32)
        for k in range(slots.shape[1]):
            out += padded[slots[:, k]]
        for lang, own in enumerate(self.lexicon):
            inside = np.array([w in own for w in words])
            out[inside] += self.lexicon_weights[lang]
        return out


# ---------------------------------------------------------------------------
# Forward-backward over many sequences

def marginals(scores: np.ndarray, mask: np.ndarray, start: np.ndarray, transitions: np.ndarray,
              before: np.ndarray | None = None, after: np.ndarray | None = None) -> np.ndarray:
    """(sequences, length, languages) marginals. ``before``: message into the first word
    (languages' probabilities up to a factor), ``after``: message into the last."""
    e = np.exp(scores - scores.max(axis=2, keepdims=True))
    step = np.exp(transitions - transitions.max())
    n, length, k = e.shape
    alpha = np.empty_like(e)
    now = np.exp(start - start.max())[None, :].repeat(n, 0) if before is None else before
    for t in range(length):
        now = (now if t == 0 else now @ step) * e[:, t]
        now /= now.sum(axis=1, keepdims=True)
        alpha[:, t] = now
    beta = np.ones((n, k), e.dtype) if after is None else after.copy()
    out = np.empty_like(e)
    last = mask.sum(axis=1) - 1
    rear = beta.copy()
    for t in range(length - 1, -1, -1):
        ended = (t >= last)[:, None]
        if t < length - 1:
            rear = np.where(ended, beta, (rear * e[:, t + 1]) @ step.T)
            rear /= rear.sum(axis=1, keepdims=True)
        both = alpha[:, t] * rear
        out[:, t] = both / both.sum(axis=1, keepdims=True)
    return out


def chain_marginals(scores: np.ndarray, first: np.ndarray, start: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Marginals of every word; text d's words are ``first[d]:first[d + 1]`` of ``scores``.
    Exact for whole texts: segments' transfer matrices carry the messages between them."""
    k = scores.shape[1]
    counts = np.diff(first)
    pieces = -(-counts // LENGTH)
    owner = np.repeat(np.arange(len(counts)), pieces)
    head = np.concatenate([[0], np.cumsum(pieces)])
    inner = np.arange(len(owner)) - head[owner]
    begin = first[owner] + inner * LENGTH
    size = np.minimum(LENGTH, first[owner + 1] - begin)
    place = np.minimum(begin[:, None] + np.arange(LENGTH), len(scores) - 1)
    mask = np.arange(LENGTH) < size[:, None]
    padded = np.where(mask[:, :, None], scores[place], np.float32(0))
    step = np.exp(transitions - transitions.max()).astype(np.float32)
    first_message = np.exp(start - start.max()).astype(np.float32)
    before = np.tile(first_message, (len(owner), 1))
    after = np.ones((len(owner), k), np.float32)
    many = np.flatnonzero(pieces[owner] > 1)
    if len(many):
        # transfer matrices of the full segments of texts with several segments
        e = np.exp(padded[many] - padded[many].max(axis=2, keepdims=True))
        matrix = np.tile(np.eye(k, dtype=np.float32), (len(many), 1, 1))
        for t in range(LENGTH):
            live = mask[many, t][:, None, None]
            matrix = np.where(live, (matrix if t == 0 else matrix @ step) * e[:, None, t], matrix)
            matrix /= matrix.sum(axis=(1, 2), keepdims=True)
        at = {int(s): i for i, s in enumerate(many)}
        for d in np.flatnonzero(pieces > 1):
            own = range(head[d], head[d + 1])
            message = first_message
            for s in own:
                before[s] = message
                message = (message @ matrix[at[s]]) @ step
                message = message / message.sum()
            message = np.ones(k, np.float32)
            for s in reversed(own):
                after[s] = message
                # through this segment, then over the step into it
                message = step @ (matrix[at[s]] @ message)
                message = message / message.sum()
    got = marginals(padded, mask, start, transitions, before, after)
    return got[mask]


# ---------------------------------------------------------------------------
# Learning

def _training_sequences(samples: list[tuple[str, list[bytes]]], langs: list[str], rng) -> tuple[list, list]:
    """Code-switched sequences: spans of the samples' words in random order."""
    spans = []
    for lang, words in samples:
        at = 0
        while at < len(words):
            n = int(rng.integers(SPAN[0], SPAN[1]))
            spans.append((langs.index(lang), words[at:at + n]))
            at += n
    order = rng.permutation(len(spans))
    flat_words = [w for k in order for w in spans[k][1]]
    flat_langs = np.array([spans[k][0] for k in order for _ in spans[k][1]], dtype=np.int64)
    return flat_words, flat_langs


def fit(samples: list[tuple[str, list[bytes]]], seed: int = 5) -> Model | None:
    """Learn from (language, words) samples."""
    langs = sorted({lang for lang, _ in samples})
    if not langs:
        return None
    rng, k = np.random.default_rng(seed), len(langs)
    samples = [(lang, normal(pieces(words))) for lang, words in samples]
    lexicon = []
    for lang in langs:
        counts: dict[bytes, int] = {}
        for own, words in samples:
            if own == lang:
                for w in words:
                    counts[w] = counts.get(w, 0) + 1
        lexicon.append(frozenset(sorted(counts, key=lambda w: (-counts[w], w))[:LEXICON]))
    words, gold = _training_sequences(samples, langs, rng)
    n = len(words) // LENGTH
    if n == 0:      # fewer words than one segment: pad with the words again
        times = -(-LENGTH // max(1, len(words)))
        words, gold, n = (words * times)[:LENGTH], np.tile(gold, times)[:LENGTH], 1
    words, gold = words[:n * LENGTH], gold[:n * LENGTH].reshape(n, LENGTH)
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.array([vocabulary[w] for w in words]).reshape(n, LENGTH)
    slots = _feature_slots(list(vocabulary))
    used = slots >= 0
    row = np.repeat(np.arange(len(vocabulary), dtype=np.int32), used.sum(axis=1))
    flat_slots = slots[used].astype(np.int32)
    del slots, used
    inside = [np.array([w in own for w in vocabulary]) for own in lexicon]
    weights = np.zeros((1 << SLOTS_LOG2, k), np.float32)
    lexicon_weights, start, transitions = np.zeros((k, k)), np.zeros(k), np.zeros((k, k))
    sums = [np.full(x.shape, 1e-8) for x in (weights, lexicon_weights, start, transitions)]
    onehot = np.eye(k)[gold]
    mask = np.ones((n, LENGTH), bool)
    model = Model(langs, weights, lexicon, lexicon_weights, start, transitions)
    pairs = np.zeros((k, k))
    np.add.at(pairs, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
    for _ in range(TRAIN_STEPS):
        table = np.zeros((len(vocabulary), k), np.float32)
        for lang in range(k):
            table[:, lang] = np.bincount(row, weights=weights[flat_slots, lang], minlength=len(vocabulary))
            table += inside[lang][:, None] * lexicon_weights[lang].astype(np.float32)
        scores = table[ids].astype(np.float64)
        got = marginals(scores, mask, start, transitions)
        expected = _expected_pairs(scores, start, transitions)
        error = np.zeros((len(vocabulary), k))
        for lang in range(k):
            error[:, lang] = np.bincount(ids.ravel(), weights=(onehot - got)[:, :, lang].ravel(), minlength=len(vocabulary))
        slopes = [np.stack([np.bincount(flat_slots, weights=error[row, lang], minlength=1 << SLOTS_LOG2)
                            for lang in range(k)], axis=1) - 0.01 * weights,
                  np.stack([error[inside[lang]].sum(axis=0) for lang in range(k)]),
                  (onehot[:, 0] - got[:, 0]).sum(axis=0), pairs - expected]
        for value, slope, total in zip((weights, lexicon_weights, start, transitions), slopes, sums):
            total += slope ** 2
            value += (0.3 * slope / np.sqrt(total)).astype(value.dtype)
    return model


def _expected_pairs(scores, start, transitions) -> np.ndarray:
    """Expected transition counts under the model."""
    e = np.exp(scores - scores.max(axis=2, keepdims=True))
    step = np.exp(transitions - transitions.max())
    n, length, k = e.shape
    alpha, beta = np.empty_like(e), np.empty_like(e)
    now = np.exp(start - start.max())[None, :].repeat(n, 0)
    for t in range(length):
        now = (now if t == 0 else now @ step) * e[:, t]
        now /= now.sum(axis=1, keepdims=True)
        alpha[:, t] = now
    now = np.ones((n, k))
    beta[:, -1] = now
    for t in range(length - 2, -1, -1):
        now = (now * e[:, t + 1]) @ step.T
        now /= now.sum(axis=1, keepdims=True)
        beta[:, t] = now
    left, right = alpha[:, :-1], (e * beta)[:, 1:]
    scale = 1 / np.einsum("nti,ij,ntj->nt", left, step, right)
    return np.einsum("nt,nti,ij,ntj->ij", scale, left, step, right)


def held_out(id_column) -> F.Column:
    return F.coalesce(F.crc32(id_column.cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          seed: int = 5) -> Model | None:
    """Fit on a seeded sample of the labelled texts that are not held out; at most
    ``TRAIN_TEXTS`` per language and ``TRAIN_WORDS`` words of each meet the driver."""
    ids = F.col(id_col).cast("long")
    usable = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ids.isNotNull() & ~held_out(ids))
    counts = usable.groupBy(lang_col).count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    draw = F.pmod(F.xxhash64(ids, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    samples = []
    wanted = F.lit(False)
    for lang, n in sorted(tuple(r) for r in counts):
        wanted = wanted | ((F.col(lang_col) == lang) & (draw < 1.5 * TRAIN_TEXTS / n + 1e-9))
    drawn = usable.where(wanted).select(draw.alias("draw"), ids.alias("id"), F.col(lang_col).alias("lang"),
                                        F.col(text_col).alias("text"))

    def some_words(batch, texts):
        out = []
        for h, text in zip(batch.column(0).to_pylist(), texts):
            words = pieces(text.split())
            at = int(h * 7919 * max(1, len(words))) % max(1, len(words) - TRAIN_WORDS + 1)
            out.append(b" ".join(words[at:at + TRAIN_WORDS]))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(out, pa.binary())],
                                          ["draw", "id", "lang", "words"])
    rows = map_texts(drawn, "text", lambda: some_words, "draw double, id long, lang string, words binary").collect()
    for lang, _ in sorted(tuple(r) for r in counts):
        own = sorted((r for r in rows if r["lang"] == lang), key=lambda r: (r["draw"], r["id"]))[:TRAIN_TEXTS]
        samples += [(lang, bytes(r["words"]).split()) for r in own]
    return fit(samples, seed)


# ---------------------------------------------------------------------------
# Prediction

class Labeller:
    """Predicts texts; keeps the emissions of the words seen, up to a bound."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}
        self.table = np.zeros((0, len(model.langs)), np.float32)
        self.letters = np.zeros(0, bool)

    def _ids(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > CACHE_WORDS:
            self.known = {}
            self.table, self.letters = self.table[:0], self.letters[:0]
        known = self.known
        new = [w for w in dict.fromkeys(words) if w not in known]
        for i, w in enumerate(new, start=len(known)):
            known[w] = i
        rows, letters = [self.table], [self.letters]
        for at in range(0, len(new), 20_000):
            some = new[at:at + 20_000]
            rows.append(self.model.emissions(normal(some)))
            letters.append(np.array([any(c.isalpha() for c in w.decode(errors="ignore")) for w in some]))
        self.table, self.letters = np.concatenate(rows), np.concatenate(letters)
        return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))

    def label(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(words, languages) marginals of all words, and whether each has a letter."""
        split = [pieces(t.split()) for t in texts]
        ids = self._ids([w for words in split for w in words])
        self.first = np.concatenate([[0], np.cumsum([len(w) for w in split])])
        if not len(ids):
            return np.zeros((0, len(self.model.langs))), np.zeros(0, bool)
        scores = self.table[ids] * self.letters[ids][:, None]     # a word without a letter says nothing
        return chain_marginals(scores, self.first, self.model.start, self.model.transitions), self.letters[ids]

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        got, letters = self.label(texts)
        owner = np.repeat(np.arange(len(texts)), np.diff(self.first))[letters]
        sums = np.stack([np.bincount(owner, weights=got[letters, k], minlength=len(texts))
                         for k in range(len(self.model.langs))], axis=1)
        total = np.bincount(owner, minlength=len(texts))
        best = sums.argmax(axis=1)
        score = np.where(total > 0, sums[np.arange(len(texts)), best] / np.maximum(total, 1), 0.0)
        return [self.model.langs[b] if t else "und" for b, t in zip(best, total)], np.clip(score, 0, 1)


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score), one per input row."""
    ids = F.col(id_col).cast("long")
    rows = docs.select(ids.alias("doc_id"), held_out(ids).alias("held_out"), F.col(text_col).alias("text"))
    schema = "doc_id long, held_out boolean, lang_pred string, score double"

    def make():
        labeller = Labeller(model) if model else None

        def f(batch, texts):
            langs, scores = labeller.predict(texts) if labeller else (["und"] * len(texts), np.zeros(len(texts)))
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(langs, pa.string()),
                                               pa.array(scores, pa.float64())], schema_names)
        return f
    schema_names = ["doc_id", "held_out", "lang_pred", "score"]
    return map_texts(rows, "text", make, schema)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return predict(docs, learn(docs))
