"""WARC archives: round trips, splits at every byte, and the query against brute force."""

import base64
import gzip
import hashlib
import os
import zlib

import pytest

from martflow.llm import warc
from martflow.session import work_dir

PAGES = "page_id long, url string, html string"


def brute(rows):
    top = {}
    for i, _, t in rows:
        if i is not None:
            top[t or ""] = max(top.get(t or "", i), i)
    out = []
    for i, _, t in rows:
        data, most = (t or "").encode(), top.get(t or "")
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "response" if i == most else "revisit", None if i == most else most))
    return sorted(out, key=str)


def query(pages, monkeypatch):
    monkeypatch.setattr(warc, "read_table", lambda *_: pages)
    return sorted(map(tuple, warc.op12_warc(pages.sparkSession, "").collect()), key=str)


EDGES = [(1, "http://a/x", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "", None), (4, "http://a/ é%20\r\nX: y", ""),
         (5, " u ", "\x00\x1f\x7f line\r\n\r\nWARC/1.0\r\n"), (6, "u%0Dv%25", "é" * 70_000), (-7, "http://n", "é" * 70_000),
         (None, "http://none", "<p>one</p>"), (None, "http://none", "alone"), (9, "http://same", "same"),
         (9, "http://same", "same"), (8, "http://other", "same"), (10, "http://big", "word and word " * 400_000)]


def test_query_against_brute_force(frame, monkeypatch):
    pages = frame([(*r, 1, "x", 2) for r in EDGES], PAGES + ", payload int, hash string, top long")
    assert query(pages, monkeypatch) == brute(EDGES)


def test_one_payload_in_most_rows(frame, monkeypatch):
    rows = [(k, f"u{k}", "hot" if k % 3 else f"own {k}") for k in range(3000)]
    assert query(frame(rows, PAGES), monkeypatch) == brute(rows)


def test_groups_beyond_the_broadcast_bound(frame, monkeypatch):
    monkeypatch.setattr(warc, "broadcast_if_small", lambda df: df)
    rows = [(k, f"u{k}", f"page {k // 2}") for k in range(500)]
    assert query(frame(rows, PAGES), monkeypatch) == brute(rows)


def test_empty_table(frame, monkeypatch):
    assert query(frame([], PAGES), monkeypatch) == []


@pytest.fixture()
def archive(spark, frame):
    folder = work_dir(spark, "warc-test")
    files = warc.write_archives(frame(EDGES, PAGES).coalesce(1), folder)
    return files, sorted(map(tuple, warc.read_archives(files).drop("path", "at").collect()), key=str)


@pytest.mark.parametrize("split", [1 << 30, 4099, 1000, 61])
def test_texts_and_urls_come_back_whatever_the_splits(archive, split):
    files, _ = archive
    got = sorted(map(tuple, warc.read_archives(files, split_bytes=split).drop("path", "at").collect()), key=str)
    assert got == archive[1]
    texts = {(r[0], r[1]): r[6] for r in got if r[2] == "response"}
    assert texts[6, "u%0Dv%25"] == ("é" * 70_000).encode()
    assert texts[5, " u "] == EDGES[4][2].encode()
    assert sorted(str(r[1]) for r in got) == sorted(str(u) for _, u, _ in EDGES)


def test_records_are_owned_once_for_any_cut(spark, archive):
    """Every cut of the bytes into two ranges gives every record once."""
    path = archive[0].first().path
    data = open(path.replace("file://", ""), "rb").read()[:3000]
    whole = [at for at, *_ in warc.scan(warc.Bytes(data), 0, len(data))]
    for cut in range(1, len(data)):
        halves = [*warc.scan(warc.Bytes(data), 0, cut), *warc.scan(warc.Bytes(data), cut, len(data))]
        assert [at for at, *_ in halves] == whole


def test_false_magic_and_foreign_members_are_skipped():
    good = warc._member(warc.record(1, "u", b"text"))
    noise = warc.MAGIC + b"\x00" * 9
    other = gzip.compress(b"not a record at all")
    cut = good[:-3]             # a truncated member has no checksum
    wrong = warc._member(warc.record(2, "u", b"text")[:-1])     # shorter than its header says
    data = noise + good + other + noise + good + wrong + cut
    starts = [at for at, *_ in warc.scan(warc.Bytes(data), 0, len(data))]
    assert starts == [len(noise), len(data) - len(cut) - len(wrong) - len(good)]


def test_an_archive_as_payload_is_not_read_as_records():
    inner = warc._member(warc.record(7, "inner", os.urandom(3000)))
    member = warc._member(warc.record(1, "outer", os.urandom(2000) + inner + os.urandom(2000)))
    stored = zlib.compressobj(0, zlib.DEFLATED, 31)
    naive = stored.compress(warc.record(1, "outer", inner)) + stored.flush()
    assert len(list(warc.scan(warc.Bytes(naive), 20, len(naive)))) == 1     # what the writer avoids
    assert list(warc.scan(warc.Bytes(member), 20, len(member))) == []
    assert len(list(warc.scan(warc.Bytes(member), 0, len(member)))) == 1


def test_members_are_plain_gzip(archive):
    path = archive[0].first().path
    text = gzip.open(path.replace("file://", ""), "rb").read()
    assert text.count(b"WARC/1.0\r\nWARC-Type: ") == len(EDGES) and text.endswith(b"\r\n\r\n")


def test_files_of_lost_attempts_are_not_read(spark, frame):
    folder = work_dir(spark, "warc-test")
    files = warc.write_archives(frame(EDGES, PAGES), folder)
    with open(f"{folder}/left.warc.gz".replace("file://", ""), "wb") as out:
        out.write(warc._member(warc.record(99, "u", b"left over")))
    assert 99 not in {r.page_id for r in warc.read_archives(files).collect()}
    assert files.agg({"records": "sum"}).first()[0] == len(EDGES)


def test_rolls_files_and_threshold(spark, frame):
    rows = [(k, "u", "same text") for k in range(50)]
    files = warc.write_archives(frame(rows, PAGES), work_dir(spark, "warc-test"), min_bytes=100, archive_bytes=1000)
    assert files.count() > 3
    kinds = [r.record_type for r in warc.read_archives(files).collect()]
    assert kinds == ["response"] * 50
