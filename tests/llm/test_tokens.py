"""Token ids, edit-aware counts and packing."""

import collections
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martflow.llm import packing, token_counts, tokens
from .conftest import CLASHING, DOCS, documents, with_clashes
from .helpers import prose, rng

CODEC = tokens.encoder(tokens.default_path())
COUNTER = token_counts.Counter(CODEC)
SF = "/root/testdata/sf0.001"


def reference(text):
    return CODEC.exact.encode(text, add_special_tokens=False).ids


PIECES = st.sampled_from(["a", "Bc", "é", " ", "  ", "\n", "\t", "'", "'s", "'ll", "l", "v", "1", "²", "¼", "_", "!", "##",
                          "\xa0", "\x85", "ñ", "don't", "<|endoftext|>", "中", " ", "\x1c", "😀", "̈", "Ж"])
TEXT = st.one_of(st.lists(PIECES, max_size=60).map("".join), st.text(max_size=80))


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_ids_are_those_of_the_library(text):
    assert CODEC.ids(text).tolist() == reference(text)
    assert "".join(CODEC.pre_tokens(text)) == text
    assert sum(COUNTER.counts(CODEC.pre_tokens(text))) == len(reference(text))


def test_ids_of_the_table(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    assert all(CODEC.ids(t).tolist() == reference(t) for t in texts)


@settings(max_examples=200, deadline=None)
@given(TEXT, st.lists(st.tuples(st.integers(-2, 90), st.integers(0, 40), TEXT), max_size=4))
def test_edits_against_whole_encoding(text, edits):
    tree = token_counts.CountTree(text, COUNTER)
    assert tree.n_tokens == len(reference(text))
    for start, length, new in edits:
        tree.edit(start, length, new)
        at = min(max(start, 0), len(text))
        text = text[:at] + new + text[at + length:]
        assert tree.text() == text
        assert tree.n_tokens == len(reference(text))


def test_an_edit_touches_little():
    text = prose(rng(1), 5000)
    tree = token_counts.CountTree(text, COUNTER)
    tree.edit(len(text) // 2, 3, "xyz")
    assert 0 < tree.encoded < 300 and tree.n_pre_tokens > 5000


def test_counts_query_against_whole_encoding(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    with_edits = docs.withColumn("edits", token_counts.pipeline_edits(F.col("text"), F.col("source")))
    rows = {r.doc_id: r for r in with_edits.collect()}
    for r in token_counts.edited_counts(with_edits).collect():
        text = rows[r.doc_id].text
        assert r.n_tokens == len(reference(text))
        for e in rows[r.doc_id].edits:
            text = text[:e.start] + e.text + text[e.start + e.length:]
        assert r.n_tokens_edited == len(reference(text))


def test_counts_edge_rows(frame):
    kind = "doc_id long, text string, edits array<struct<start:int,length:int,text:string>>, tokens long, n_tokens string"
    rows = [(0, None, None, 1, "x"), (1, "", [], 1, "x"), (2, "ab", [(5, 9, "cd")], 1, "x"), (2, "ab", [(0, None, None)], 1, "x"),
            (None, "a b", [None, (-3, 1, "z")], 1, "x")]
    got = sorted((str(r.doc_id), r.n_tokens, r.n_tokens_edited)
                 for r in token_counts.edited_counts(frame(rows, kind)).collect())
    n = lambda t: len(reference(t))
    assert got == sorted([("0", 0, 0), ("1", 0, 0), ("2", n("ab"), n("abcd")), ("2", n("ab"), n("ab")),
                          ("None", n("a b"), n("z b"))])
    assert token_counts.edited_counts(frame([], kind)).count() == 0


# -- packing ----------------------------------------------------------------

def one_by_one(lengths, size):
    """Sequences used by best-fit decreasing, a piece at a time."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [k for k, r in enumerate(rooms) if r >= n]
        if fit:
            rooms[min(fit, key=lambda k: rooms[k])] -= n
        else:
            rooms.append(size - n)
    return len(rooms), sorted(rooms)


@pytest.mark.parametrize("seed", range(12))
def test_runs_equal_piece_by_piece(seed):
    r = random.Random(seed)
    size = r.choice([10, 37, 128])
    lengths = [min(size, max(1, int(r.expovariate(3 / size)))) if seed % 2 else r.randrange(1, size + 1)
               for _ in range(r.choice([1, 5, 300]))]
    counts = collections.Counter(lengths)
    runs, used = packing.plan_runs(dict(counts), size), collections.defaultdict(list)
    for n, c in counts.items():
        for k in range(c):
            row = runs[n][np.searchsorted(runs[n][:, 0], k, side="right") - 1]
            i = k - row[0]
            used[int(row[1] + i // row[2])].append((int(row[3] + i % row[2] * n), n))
    rooms = []
    for places in used.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= size
        rooms.append(size - at)
    assert (len(rooms), sorted(rooms)) == one_by_one(lengths, size)


def check_packing(rows, texts):
    """Gapless sequences, pieces by the rule, ids as the library gives them."""
    sequences = collections.defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= packing.MAX_TOKENS
    got = collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    want = collections.Counter()
    for i, t in texts:
        ids = np.array(reference(t or "") + [packing.END_ID], dtype="<u4")
        for k, (at, n) in enumerate(packing.cut(len(ids), packing.MAX_TOKENS)):
            assert k == 0 or n == packing.MAX_TOKENS
            want[(i, k, at, n, zlib.crc32(ids[at:at + n].tobytes()))] += 1
    assert got == want
    assert len(sequences) == one_by_one([r.length for r in rows], packing.MAX_TOKENS)[0]


def test_packing_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check_packing(packing.pack(docs).collect(), [tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_packing_edge_rows(frame):
    texts = [None, "", "a", "a", "b " * 1023, "b " * 1024, prose(rng(2), 9000), "中文" * 50] + ["x y"] * 30
    rows = documents(texts) + [(None, "a", None, None, None), (3, "a", None, None, None)]
    check_packing(packing.pack(frame(with_clashes(rows), CLASHING)).collect(), [r[:2] for r in rows])
    assert packing.pack(frame([], DOCS)).count() == 0
