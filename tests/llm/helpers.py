"""Brute-force versions of the operators, for small tables."""

import collections
import hashlib
import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, width=5):
    w = words(lower(text))
    if not w:
        return set()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)}


def near_components(rows):
    """{doc_id: smallest id reachable} by comparing all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    having = collections.defaultdict(set)
    for i, s in sets.items():
        for x in s:
            having[x].add(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, s in sets.items():
        for j in {j for x in s for j in having[x] if j < i}:
            if 100 * len(s & sets[j]) >= 75 * len(s | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def without_repeats(rows, width=35):
    """[(doc_id, n_words, n_removed, sha256)] with windows that start twice removed."""
    split = [(i, words(t)) for i, t in rows]
    starts = collections.Counter(tuple(w[k:k + width]) for _, w in split for k in range(len(w) - width + 1))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if starts[tuple(w[k:k + width])] > 1:
                gone[k:k + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def removed_lines(rows, percent=80):
    """{(position of row, line)} of lines with an earlier match; rows in order of id."""
    lines = []
    for k, (i, t) in enumerate(rows):
        for n, line in enumerate((t or "").split("\n")):
            s = frozenset(words(lower(line)))
            if s:
                lines.append(((-1 << 63) if i is None else i, n, k, s))
    lines.sort(key=lambda x: x[:3])
    having, gone = collections.defaultdict(list), set()
    for at, (_, n, k, s) in enumerate(lines):
        for other in {o for w in s for o in having[w]}:
            if 100 * len(s & lines[other][3]) >= percent * len(s | lines[other][3]):
                gone.add((k, n))
                break
        for w in s:
            having[w].append(at)
    return gone


def base_counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    t = text or ""
    w = words(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = collections.defaultdict(list)
    for i in range(len(w) - 7):
        grams[tuple(w[i:i + 8])].append(i)
    inside = {j for at in grams.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(inside),
            len(w) < 20 or 100 * len(inside) > 30 * len(w))


def edited(text, rng, edits=2):
    w = text.split(" ")
    for _ in range(edits):
        w[rng.randrange(len(w))] = rng.choice(["red", "blue", "green", "violet"])
    return " ".join(w)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def rng(seed=1):
    return random.Random(seed)
