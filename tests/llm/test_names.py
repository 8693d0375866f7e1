"""Pipeline stages over documents whose other columns have the stages' own names."""

import pytest

from martflow.llm import exact_dedup, minhash, mixing, quality
from martflow.llm.common import free_names
from .conftest import DOCS, documents
from .helpers import edited, prose, rng

NAMES = ["_row", "_id", "_mark", "_gone", "_n", "_size", "_shard", "_shards", "_use", "_h", "_part", "_passes", "__row",
         "doc_id_", "rep", "component", "kept", "size", "h"]
WIDE = DOCS + "".join(f", `{n}` int" for n in NAMES)


def texts():
    r = rng(11)
    base = prose(r, 150)
    return [base, base, base.upper(), edited(base, r), None, "", prose(r, 200), prose(r, 40) + "\n" + prose(r, 40), prose(r, 3)] + [
        prose(r, 60) for _ in range(12)]


@pytest.mark.parametrize("stage", [quality.keep_rows, exact_dedup.keep_rows, minhash.keep_rows, mixing.mixed_rows])
def test_same_rows_and_same_values(frame, stage):
    rows = [(*r[:3], "a" if k % 3 else "b", r[4]) for k, r in enumerate(documents(texts()))]
    plain = sorted(map(tuple, stage(frame(rows, DOCS)).collect()), key=str)
    wide = stage(frame([(*r, *range(100 * r[0], 100 * r[0] + len(NAMES))) for r in rows], WIDE))
    assert wide.columns == [*(c.split()[0] for c in DOCS.split(", ")), *NAMES]
    got = wide.collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == plain
    assert all(tuple(r)[5:] == tuple(range(100 * r.doc_id, 100 * r.doc_id + len(NAMES))) for r in got)


def test_repeated_rows_keep_one_with_clashing_names(frame):
    rows = [(1, "a b", "en", "s", 3, *range(len(NAMES)))] * 3 + [(2, "c", "en", "s", 1, *range(len(NAMES)))]
    assert sorted(r.doc_id for r in exact_dedup.keep_rows(frame(rows, WIDE)).collect()) == [1, 2]


def test_free_names(spark):
    df = spark.createDataFrame([], "`_A` int, `__a` int, b int")
    assert free_names(df, "_a", "_b", "_a") == ["___a", "_b", "____a"]
