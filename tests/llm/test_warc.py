"""Archives: exact round trips, transactions, revisits."""

import gzip
import hashlib
import os
from collections import Counter

import pytest
from pyspark.errors import PySparkException

from clickwave.llm import warc
from tests.llm.fixtures import with_clashing

BIG = "<p>" + "x" * 200 + "</p>"
PAGES = [(1, "http://a.example/1", BIG), (2, "http://a.example/2", BIG), (3, None, BIG), (4, "http://b.example/\r\nX: y", None),
         (5, "", ""), (6, "http://b.example/6", "short"), (7, "http://b.example/7", "short"),
         (8, "http://c.example/", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n\r\n" * 9),
         (9, "http://c.example/ü", "漢字🙂 " * 60), (10, "http://c.example/ü", "漢字🙂 " * 60), (11, "u", "y" * 99), (12, "u", "y" * 99),
         (13, "u", "z" * 100), (14, "u", "z" * 100), (15, "u", "\r\n\r\n" * 50), (16, "u", "long " * 200_000),
         (None, "u", BIG), (None, "u", "only without an id " * 20), (None, "v", "only without an id " * 20),
         (17, "u", "twice " * 50), (17, "u", "twice " * 50)]


def plain(rows):
    out = Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, other in rows if (other or "").encode() == data]
        first = min((j for j in same if j is not None), default=None)
        revisit = len(data) >= 100 and first is not None and i != first
        out[i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None] += 1
    return out


def pages(spark, rows):
    return with_clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))


@pytest.mark.parametrize("archive_bytes,small,compression", [(16_000_000, 20_000, "gzip"), (1000, 20_000, "none"), (1000, 0, "gzip")])
def test_round_trip(spark, tmpdir_fresh, monkeypatch, archive_bytes, small, compression):
    monkeypatch.setattr(warc, "SMALL_PAYLOADS", small)  # 0: digests are dealt, not sent to all
    df = pages(spark, PAGES).repartition(3)
    got = warc.archived_pages(df, folder=f"{tmpdir_fresh}/out", archive_bytes=archive_bytes, compression=compression)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert Counter(map(tuple, got.collect())) == plain(PAGES)
    files = [f for f in os.listdir(f"{tmpdir_fresh}/out") if f.startswith("part")]
    assert len(files) >= (3 if archive_bytes < 2000 else 1)


def test_captures_hold_the_payload(spark, tmpdir_fresh):
    warc.write_archives(pages(spark, PAGES), f"{tmpdir_fresh}/out")
    records = warc.read_archives(spark, f"{tmpdir_fresh}/out")
    assert Counter(r.type for r in records.collect()) == {"request": 21, "metadata": 21, "response": 16, "revisit": 5}
    rows = warc.captures(records).collect()
    assert len(rows) == len(PAGES) and all(r.request.uri == r.metadata.uri == r.uri for r in rows)
    got = Counter((r.metadata.page_id, bytes(r.payload).decode()) for r in rows if r.record_type == "response")
    revisits = {k for k, *_ , kind, _ in plain(PAGES) if kind == "revisit"}
    assert {(i, t) for i, t in got} >= {(str(i), h or "") for i, _, h in PAGES if i is not None and i not in revisits}


def test_records_are_joined_by_identifier_only(spark, tmpdir_fresh):
    """Records of a capture in any order and in different, also compressed, archives."""
    made = [r for k in range(40) for r in warc.capture_records(k, str(k), f"u{k}", f"page {k}", hashlib.sha256(f"page {k}".encode()).hexdigest(), None, False)]
    os.makedirs(f"{tmpdir_fresh}/in")
    for part in range(3):  # responses, requests and metadata apart
        mine = [r + b"\r\n\r\n" for r in made[part::3][::-1]]
        with open(f"{tmpdir_fresh}/in/{part}.warc{'.gz' if part else ''}", "wb") as f:
            f.writelines(gzip.compress(r) if part else r for r in mine)
    rows = warc.captures(warc.read_archives(spark, f"{tmpdir_fresh}/in")).collect()
    assert sorted((int(r.metadata.page_id), r.request.uri, bytes(r.payload)) for r in rows) == [
        (k, f"u{k}", f"page {k}".encode()) for k in range(40)]


@pytest.mark.parametrize("content", [b"WARC/1.1\r\nContent-Length: 50\r\n\r\nshort", b"WARC/1.1\r\nWARC-Type: response\r\n\r\n", b"no archive"])
def test_a_broken_archive_is_an_error(spark, tmpdir_fresh, content):
    with open(f"{tmpdir_fresh}/a.warc", "wb") as f:
        f.write(content)
    with pytest.raises(PySparkException):
        warc.read_archives(spark, tmpdir_fresh).collect()


def test_an_empty_table(spark, tmpdir_fresh):
    got = warc.archived_pages(pages(spark, []), folder=f"{tmpdir_fresh}/out")
    assert got.count() == 0 and dict(got.dtypes)["page_id"] == "bigint"
