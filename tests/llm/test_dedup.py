"""Exact, near, passage and line dedup against brute force."""

import hashlib
import tracemalloc

import numpy as np
import pytest

from martflow.llm import exact_dedup, line_dedup, minhash, substring_dedup
from .conftest import CLASHING, DOCS, documents, with_clashes
from .helpers import edited, lower, near_components, prose, removed_lines, rng, words, without_repeats

SF = "/root/testdata/sf0.001"


def table(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def edge_texts():
    r = rng(3)
    long = prose(r, 30_000, 5000)
    base = prose(r, 120)
    passage = prose(r, 60)
    texts = [None, "", " \t\n ", "one", "one", "ONE", "one two three", "one  two\tthree", "É é", "é é", long, long + " x",
             base, base, base.upper(), passage, prose(r, 10) + " " + passage + " " + prose(r, 10),
             passage + " " + passage, "a " * 100, "a " * 34, "a " * 35, "a " * 36]
    texts += [edited(base, r) for _ in range(12)]
    texts += [edited(base, r, 8) for _ in range(12)]
    return texts


# -- exact ------------------------------------------------------------------

def expect_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    return sorted((i, max(groups[lower(t)]), len(groups[lower(t)]), i == max(groups[lower(t)]),
                   hashlib.sha256(lower(t).encode()).hexdigest()) for i, t in rows)


@pytest.mark.parametrize("digest_all", [True, False])
def test_exact_against_brute_force(spark, frame, digest_all):
    rows = documents(edge_texts())
    docs = frame(with_clashes(rows), CLASHING)
    got = exact_dedup.exact_dedup(docs, digest_all=digest_all).collect()
    want = expect_exact([r[:2] for r in rows])
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got) == [w[:4] for w in want]
    if digest_all:
        assert sorted((r.doc_id, r.digest.hex()) for r in got) == [(w[0], w[4]) for w in want]


def test_exact_keep_rows_with_repeated_rows_and_null_ids(frame):
    rows = documents(["a b", "A b", "c"])
    rows += [rows[1], rows[2], (None, "c", None, None, None), (None, "d", None, None, None), (None, "d", None, None, None)]
    got = exact_dedup.keep_rows(frame(rows, DOCS)).collect()
    assert sorted((str(r.doc_id), r.text) for r in got) == [("1", "A b"), ("2", "c"), ("None", "d")]


def test_exact_empty(frame):
    docs = frame([], DOCS)
    assert exact_dedup.exact_dedup(docs).count() == 0 and exact_dedup.keep_rows(docs).count() == 0


# -- near -------------------------------------------------------------------

def test_near_against_brute_force_on_table(spark):
    docs = table(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in minhash.near_duplicates(docs).collect()}
    want = near_components(rows)
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())


def test_near_edge_rows(frame):
    rows = documents(edge_texts())
    got = {r.doc_id: r for r in minhash.near_duplicates(frame(with_clashes(rows), CLASHING)).collect()}
    want = near_components([r[:2] for r in rows])
    assert {i: r.component_id for i, r in got.items()} == want
    assert got[0].n_shingles == got[1].n_shingles == got[2].n_shingles == 0


def test_near_chain_without_common_centre(frame):
    """Neighbours are linked, ends are not: one class through the rest pass and long paths."""
    r = rng(9)
    w = [f"w{k}" for k in range(200)]
    texts = []
    for _ in range(14):
        texts.append(" ".join(w))
        for _ in range(4):
            w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
    order = list(range(14))
    r.shuffle(order)
    rows = documents([texts[k] for k in order])
    got = {x.doc_id: x.component_id for x in minhash.near_duplicates(frame(rows, DOCS)).collect()}
    assert got == near_components([x[:2] for x in rows])


def test_near_repeated_rows_null_ids_and_empty(frame):
    rows = documents(["a b c d e f", "a b c d e f"]) + documents(["a b c d e f"]) + [(None, "q r", None, None, None)]
    got = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in minhash.near_duplicates(frame(rows, DOCS)).collect())
    assert got == [("0", "0", True), ("0", "0", True), ("1", "0", False), ("None", "None", True)]
    assert minhash.near_duplicates(frame([], DOCS)).count() == 0
    assert minhash.keep_rows(frame(rows, DOCS)).count() == 3


def test_sketch_estimates_similarity():
    a = [" ".join(f"t{k}" for k in range(400)), " ".join(f"t{k}" for k in range(60, 460))]
    values, first = minhash.shingle_sets([x.encode() for x in a])
    s = minhash.sketches(values, first)
    assert (s != ~np.uint64(0)).all()
    true = 336 / 456
    assert abs((s[0] == s[1]).mean() - true) < 0.15
    small = minhash.sketches(*minhash.shingle_sets([b"just one", b"", b"a b c d e f"]))
    assert (small[0] != ~np.uint64(0)).all() and (small[1] == ~np.uint64(0)).all() and (small[2] != ~np.uint64(0)).all()


# -- passages ---------------------------------------------------------------

def test_passages_against_brute_force_on_table(spark):
    docs = table(spark)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = substring_dedup.repeated_passages(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(without_repeats(rows))


def test_passages_edge_rows(frame):
    rows = documents(edge_texts())
    rows += [rows[12], (None, rows[12][1], None, None, None)]
    got = substring_dedup.repeated_passages(frame(with_clashes(rows), CLASHING)).collect()
    want = without_repeats([r[:2] for r in rows])
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=key) == sorted(want, key=key)
    for r in got:
        assert sum(s.end - s.start for s in r.repeats) == r.n_removed
    assert substring_dedup.repeated_passages(frame([], DOCS)).count() == 0


@pytest.mark.parametrize("shift", range(0, 36, 5))
def test_passage_of_exactly_one_window_at_any_place(frame, shift):
    r = rng(shift)
    p = " ".join(f"p{k}" for k in range(35))
    rows = documents([prose(r, shift, 10**6) + " " + p + " " + prose(r, 40, 10**6),
                      prose(r, 17, 10**6) + " " + p, prose(r, 50, 10**6) + " " + p.rsplit(" ", 1)[0]])
    got = {x.doc_id: x.n_removed for x in substring_dedup.repeated_passages(frame(rows, DOCS)).collect()}
    assert got == {0: 35, 1: 35, 2: 0}


def test_packed_runs_round_trip():
    for kind in (np.uint32, np.uint64):
        v = np.sort(np.random.default_rng(1).integers(0, np.iinfo(kind).max, 1000, dtype=kind))
        assert (substring_dedup.unpack(substring_dedup.pack(v), kind) == v).all()
        assert len(substring_dedup.unpack(substring_dedup.pack(v[:0]), kind)) == 0


# -- lines ------------------------------------------------------------------

def check_lines(docs, rows):
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_lines, r.n_removed, r.kept_text)
                 for r in line_dedup.line_dedup(docs).collect())
    gone, want = removed_lines(rows), []
    for k, (i, t) in enumerate(rows):
        lines = (t or "").split("\n")
        out = [x for n, x in enumerate(lines) if (k, n) not in gone]
        want.append((i is not None, i or 0, len(lines) if t else 0, len(lines) - len(out), "\n".join(out)))
    assert got == sorted(want)


def test_lines_against_brute_force_on_table(spark):
    docs = table(spark)
    check_lines(docs, [tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_lines_edge_rows(frame):
    r = rng(5)
    line = prose(r, 20)
    texts = [None, "", "\n\n", " \n", "one", "ONE\none", "one two", line, edited(line, r) + "\n" + line,
             "\n".join(edited(line, r, 1) for _ in range(40)), "\n".join(edited(line, r, 3) for _ in range(40)),
             prose(r, 3000) + "\n" + prose(r, 5)] + ["\n".join(prose(r, r.randrange(1, 12), 12) for _ in range(60)) for _ in range(4)]
    rows = documents(texts)
    check_lines(frame(with_clashes(rows), CLASHING), [x[:2] for x in rows])
    assert line_dedup.line_dedup(frame([], DOCS)).count() == 0


def test_lines_at_080_are_removed(frame):
    """One word replaced in nine (8/10) and in twelve (11/13) matches; 7/9 does not."""
    nine, twelve, eight = ([f"{p}{k}" for k in range(n)] for p, n in (("a", 9), ("b", 12), ("c", 8)))
    text = "\n".join(" ".join(x) for w in (nine, twelve, eight) for x in (w, w[:-1] + ["other" + w[0]]))
    (row,) = line_dedup.line_dedup(frame(documents([text]), DOCS)).collect()
    assert row.n_removed == 2 and row.kept_text.split("\n") == [text.split("\n")[k] for k in (0, 2, 4, 5)]


def test_lines_second_pass_is_needed_and_exact(frame, monkeypatch):
    """With one try per word many lines need the second pass; the result is the same."""
    monkeypatch.setattr(line_dedup, "FIRST_TRIES", 1)
    r = rng(8)
    rows = documents(["\n".join(prose(r, r.randrange(4, 10), 9) for _ in range(50)) for _ in range(5)])
    check_lines(frame(rows, DOCS), [x[:2] for x in rows])


def test_lines_of_a_hot_word_are_exact(frame, monkeypatch):
    """Words with far more lines than a line meets at first; the result is that of all pairs."""
    monkeypatch.setattr(line_dedup, "NEIGHBOURS", 3)
    r = rng(12)
    same = prose(r, 14)
    rows = documents(["\n".join(f"{same} n{r.randrange(10**6)}" if r.randrange(3) else prose(r, r.randrange(5, 9), 10)
                                for _ in range(60)) for _ in range(4)])
    check_lines(frame(rows, DOCS), [x[:2] for x in rows])


def test_lines_memory_does_not_follow_the_square_of_a_group():
    """6000 variants of a line have 18 million pairs (430 MB); only the closest are held."""
    n = 6000
    c = {"token": np.zeros(n, np.uint32), "doc": np.arange(n, dtype=np.uint64), "line": np.zeros(n, np.uint32),
         "leader": np.arange(n), "blob": np.zeros(n, np.int64), "size": np.full(n, 15, np.uint32),
         "place": np.zeros(n, np.uint32), "low": np.full(n, 0x7FFF, np.uint64), "high": np.zeros(n, np.uint64)}
    tracemalloc.start()
    later, earlier, more = line_dedup._closest(line_dedup._candidates(c, line_dedup._reach(c), n), 5, n)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (np.bincount(later, minlength=n) == np.minimum(np.arange(n), 5)).all() and (earlier < later).all()
    assert (more == (later > 5)).all() and peak < 120 << 20, peak


def test_lines_common_words_leave_the_signature_to_rare_ones():
    """Lines of 200 words of which 140 are common: no pair can match, and the signatures tell."""
    texts = [" ".join([f"c{k}" for k in range(140)] + [f"r{n}x{k}" for k in range(60)]).encode() for n in range(40)]
    lines = line_dedup.Lines([b"\n".join(texts)])
    slots = (lines.h >> np.uint64(64 - line_dedup.COUNTERS_LOG2)).astype(np.int64)
    ranks = line_dedup._ranks(np.bincount(slots, minlength=1 << line_dedup.COUNTERS_LOG2))
    sets = line_dedup.WordSets(lines, np.arange(40), (ranks, int(line_dedup._ranks(np.array([20]))[0])))
    c = dict(zip(("low", "high"), sets.signatures()))
    a, b = np.triu_indices(40, 1)
    one, two = line_dedup._only(c, a, b)
    assert one.max() <= 60 and (one > 200 - 178).mean() > 0.5 and (np.maximum(one, two) > 200 - 178).mean() > 0.7


def test_lines_words_are_common_by_their_share():
    ranks, common = line_dedup._word_order(np.array([1] * 500 + [50] * 10))
    assert (ranks[:500] < common).all() and (ranks[500:] >= common).all()
    line_dedup._word_order(np.zeros(8, np.int64))       # no words


def test_lines_second_pass_posts_only_sizes_that_can_match():
    line = " ".join(f"a{k}" for k in range(100))
    lines = line_dedup.Lines([f"{line}\n{line[:29]}\n{line[:32]} b\n{line[:23]}".encode()])      # 100, 10, 11, 8 words
    counts = np.ones(1 << line_dedup.COUNTERS_LOG2, np.int64)
    sets = line_dedup.WordSets(lines, np.arange(4), line_dedup._word_order(counts))
    assert sets.size.tolist() == [100, 10, 11, 8]
    for low, high, want in ((10, 10, [1, 2, 3]), (100, 100, [0]), (1 << 40, 0, [])):
        slots = tuple(np.full(1 << line_dedup.SLOTS_LOG2, n) for n in (low, high))
        _, columns = line_dedup._posting_rows({"ids": [7]}, lines, sets, np.arange(4), 3, slots)
        assert sorted({n for v in columns["leader"] for n in v.tolist()}) == want


def test_lines_closest_pair_of_a_line_is_verified_first(frame, monkeypatch):
    asked, matches = [], line_dedup._matches
    monkeypatch.setattr(line_dedup, "_matches", lambda pairs, lines: (asked.append(pairs), matches(pairs, lines))[1])
    r = rng(21)
    line = prose(r, 16)
    rows = documents(["\n".join([edited(line, r, r.randrange(1, 4)) for _ in range(12)] +
                                [prose(r, r.randrange(4, 10), 9) for _ in range(20)]) for _ in range(4)])
    check_lines(frame(rows, DOCS), [x[:2] for x in rows])
    first, others = ([tuple(p)[:4] for p in pairs.select(*line_dedup._SIDES).collect()] for pairs in asked)
    assert len({p[:2] for p in first}) == len(first) and not set(first) & set(others)
    assert {p[:2] for p in others} <= {p[:2] for p in first} and len(others) < len(first) * 3
