"""Merkle manifests against a plain tree in Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from martflow.llm import merkle
from .conftest import CLASHING, DOCS, with_clashes
from .helpers import lower


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    i, _, lang, source, n = row[:5]
    return h(*[field(x) for x in (i, source, lang, n, text)])


def climb(nodes, fanout=16):
    """(root, [(siblings left, right) per level] of each node)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k:k + fanout] for k in range(0, len(nodes), fanout)]
        for k, path in enumerate(paths):
            run, slot = runs[at[k] // fanout], at[k] % fanout
            path.append(("".join(run[:slot]), "".join(run[slot + 1:])))
            at[k] //= fanout
        nodes = [h(*run) for run in runs]
    return (nodes[0] if nodes else None), paths


def expected(rows):
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    trees, keys = [], sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for key in keys:
        mine = sorted(by[key], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees.append((mine, *climb([leaf(r, r[1]) for r in mine])))
    root, over = climb([sub for _, sub, _ in trees])
    out = []
    for (mine, sub, paths), up in zip(trees, over):
        for r, path in zip(mine, paths):
            tamper = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            folded = leaf(r, lower(r[1]) if tamper and r[1] is not None else r[1])
            for left, right in path + up:
                folded = h(left, folded, right)
            out.append((r[0], leaf(r, r[1]), sub, root, h(*[a + b for a, b in path + up]), folded, folded == root))
    return sorted(out, key=str)


def found(docs, monkeypatch):
    monkeypatch.setattr(merkle, "read_table", lambda *_: docs)
    return sorted(map(tuple, merkle.op11_merkle_manifest(docs.sparkSession, "").collect()), key=str)


def rows_of(sizes):
    rows, i = [], 0
    for source, n in sizes:
        for _ in range(n):
            rows.append((i * 7 % 5003, f"Text {i} É" if i % 11 else None, [None, "en", "", "de"][i % 4], source, i % 9 or None))
            i += 1
    return rows


SIZES = [
    [("a", 1)], [("a", 16)], [("a", 17)], [("b", 1), ("a", 2)],
    # 300 leaves make three levels, 20 sources two; null and empty sources differ; bytewise order
    [("hot", 300), (None, 5), ("", 3), ("É", 2), ("z", 257), ("Z", 33)] + [(f"s{k}", k % 3 + 1) for k in range(16)],
]


@pytest.mark.parametrize("sizes", SIZES, ids=lambda s: str(sum(n for _, n in s)))
def test_manifest_against_plain_trees(frame, monkeypatch, sizes):
    rows = rows_of(sizes)
    assert found(frame(with_clashes(rows), CLASHING), monkeypatch) == expected(rows)


def test_null_ids_equal_ids_and_repeated_rows(frame, monkeypatch):
    rows = [(1, "A", "en", "s", 1)] * 20 + [(1, "B", "en", "s", 1), (None, "C", None, "s", None),
                                            (None, None, None, "s", None), (2, "", "", "", 0), (3, "x" * 200_000, "en", None, 5)]
    assert found(frame(rows, DOCS), monkeypatch) == expected(rows)


def test_tampering_is_seen_and_only_there(frame, monkeypatch):
    rows = rows_of([("a", 40), ("b", 7)])
    for doc_id, *_, verified in found(frame(rows, DOCS), monkeypatch):
        text = next(r[1] for r in rows if r[0] == doc_id)
        changed = text is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        assert verified is not changed


def test_empty_table(frame, monkeypatch):
    assert found(frame([], DOCS), monkeypatch) == []


def test_other_columns_and_names(frame):
    """The operator's own interface: any columns, tree and order."""
    docs = frame([(k, f"g{k % 2}", float(k)) for k in range(40)], "tree long, pos string, n double")
    got = merkle.proofs(docs, columns=("tree", "n"), tree="pos", order="tree")
    rows = got.withColumn("ok", merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).collect()
    assert len(rows) == 40 and all(r.ok for r in rows) and len({r.root for r in rows}) == 1
    assert {r.key: r.subroot for r in rows}.keys() == {"g0", "g1"}
    assert len({r.subroot for r in rows}) == 2 and all(r.altered_leaf is None for r in rows)


def test_hot_source_is_spread_over_partitions(spark, frame, monkeypatch):
    """One source with all rows: its leaves are ordered in many tasks, not in one."""
    rows, saved = rows_of([("hot", 4000)]), []
    save = merkle.save
    monkeypatch.setattr(merkle, "save", lambda df, name: saved.append(save(df, name)) or saved[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = merkle.ranked(frame(rows, DOCS), "source", "doc_id").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r.doc_id for r in sorted(placed, key=lambda r: r.place)] == sorted(r[0] for r in rows)
    assert [r.place for r in sorted(placed, key=lambda r: r.place)] == list(range(4000))
    sizes = [r["count"] for r in saved[0].groupBy(F.shiftright("_seq", 33)).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 4000
