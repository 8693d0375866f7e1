"""Spelling variants against all pairs."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

from martflow.llm import spelling
from .conftest import CLASHING, DOCS, documents, with_clashes
from .helpers import lower

SF = "/root/testdata/sf0.001"


def counted(rows):
    n = collections.Counter()
    for i, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = lower(w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def expected(words):
    """Rows (word, form, root, n, n_near, form_n) by comparing words that share a cut."""
    cuts = collections.defaultdict(set)
    for w in words:
        for c in {w, *(w[:k] + w[k + 1:] for k in range(len(w)))}:
            cuts[c].add(w)
    form, rows = {}, {}
    for w, n in words.items():
        close = {o for c in {w, *(w[:k] + w[k + 1:] for k in range(len(w)))} for o in cuts[c] if near(w, o)}
        best = min(close, key=lambda o: (-words[o], o), default=None)
        ok = best is not None and words[best] >= 2 * n
        form[w] = best if ok else None
        rows[w] = (n, len(close), words[best] if ok else None)
    out = []
    for w, (n, n_near, form_n) in rows.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, n_near, form_n))
    return sorted(out, key=str)


def found(docs, monkeypatch):
    monkeypatch.setattr(spelling, "read_table", lambda *_: docs)
    return sorted(map(tuple, spelling.op13_spelling_variants(docs.sparkSession, "").collect()), key=str)


def test_sf_documents_against_brute_force(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert found(docs, monkeypatch) == expected(counted([(r.doc_id, r.text) for r in docs.collect()]))


def typo_texts(seed=5):
    r = random.Random(seed)
    letters = "abcdefghéÉß÷×z"
    base = ["".join(r.choice(letters) for _ in range(r.randrange(4, 9))) for _ in range(25)]

    def typo(w):
        k = r.randrange(len(w) + 1)
        return r.choice([w[:k] + r.choice(letters) + w[k:], w[:k] + w[k + 1:], w[:k] + r.choice(letters) + w[k + 1:]])
    words = [w for b in base for w in [b] * 12 + [x for _ in range(6) for x in [typo(b)] * r.randrange(1, 7)]]
    r.shuffle(words)
    return [" ".join(words[k:k + 20]) for k in range(0, len(words), 20)] + [
        None, "", "1234 αβγδε -", "Alpha-alpha ALPHA alphā aLphas", "long " * 30_000 + "lonng " * 9]


@pytest.mark.parametrize("symbols", [1, 2, 4, None])
def test_any_alphabet_gives_the_same(frame, monkeypatch, symbols):
    rows = documents(typo_texts())
    if symbols:
        monkeypatch.setattr(spelling, "symbols_for", lambda size: symbols)
    assert found(frame(with_clashes(rows), CLASHING), monkeypatch) == expected(counted([r[:2] for r in rows]))


def test_chains_ties_null_ids_and_repeated_rows(frame, monkeypatch):
    chain = ["abcdefgh"] * 48 + ["abcdefgx"] * 24 + ["abcdefyx"] * 12 + ["abcdezyx"] * 6 + ["abcdwzyx"] * 3
    tie = ["mmmmma"] * 9 + ["mmmmmb"] * 9 + ["mmmmm"] * 4 + ["mmmmmc"] * 5
    rows = [(None, " ".join(chain), None, None, None)] + [(7, " ".join(tie), "en", "s", 1)] * 3
    got = found(frame(rows, DOCS), monkeypatch)
    assert got == expected(counted([r[:2] for r in rows]))
    assert {r[2] for r in got if r[0].startswith("abcd")} == {"abcdefgh"}


def test_shuffled_candidates_and_links(frame, monkeypatch):
    """Beyond the broadcast bounds the same joins run as shuffles."""
    monkeypatch.setattr(spelling, "broadcast_if_small", lambda df, *_: df)
    rows = documents(typo_texts(8))
    assert found(frame(rows, DOCS), monkeypatch) == expected(counted([r[:2] for r in rows]))


def test_empty_table(frame, monkeypatch):
    assert found(frame([], DOCS), monkeypatch) == []


def test_neighbourhoods_are_whole():
    """Keys of every edit of the reduced word, and nothing else."""
    words, symbols = ["abcd", "aab", "z"], 3
    owner, key = spelling.neighbourhoods(words, symbols)
    letters, lengths = spelling._letters(words, symbols)
    base = spelling._BASE
    at = 0
    for k, n in enumerate(lengths):
        s = [int(x) for x in letters[at:at + n]]
        at += n
        edits = {tuple(s)} | {tuple(s[:i] + s[i + 1:]) for i in range(n)}
        edits |= {tuple(s[:i] + [c] + s[i + 1:]) for i in range(n) for c in range(1, symbols + 1)}
        edits |= {tuple(s[:i] + [c] + s[i:]) for i in range(n + 1) for c in range(1, symbols + 1)}
        want = {sum(c * pow(base, i, 1 << 64) for i, c in enumerate(e)) % (1 << 64) for e in edits}
        assert set(key[owner == k].tolist()) == want and len(want) == np.count_nonzero(owner == k)


def test_alphabet_grows_slowly():
    assert [spelling.symbols_for(n) for n in (0, 1000, 10**6, 10**9)] == [4, 4, 6, 14]
