from __future__ import annotations

import gzip
import hashlib
import json
import zlib

import pytest

from acquaint.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, first long, n long, payload string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 1, "x") for r in rows], SCHEMA)


def hard_pages():
    long = "<p>é\r\n\r\nWARC/1.1\r\n" * 20
    return [
        (5, "http://a/ b\r\nX: y", long), (2, "http://a/2", long), (9, None, long), (None, "http://n", long),
        (3, "http://a/3", "short"), (4, "http://a/4", "short"), (6, "http://a/6", None), (7, "http://a/7", ""),
        (8, "http://a/8", "x" * 100), (10, "http://a/8", "x" * 100), (11, "http://e", "y" * 99), (12, "", "y" * 99),
        (8, "http://a/8", "x" * 100), (13, "http://long", "z\0" * 200_000),
    ]


def wanted(rows):
    firsts = {}
    for page, _, html in rows:
        if page is not None and len((html or "").encode()) >= 100:
            firsts[html] = min(page, firsts.get(html, page))
    found = []
    for page, _, html in rows:
        payload = (html or "").encode()
        first = firsts.get(html)
        again = first is not None and page != first
        found.append((page, len(payload), hashlib.sha256(payload).hexdigest(),
                      "revisit" if again else "response", first if again else None))
    return sorted(found, key=str)


def test_pages_come_back(spark):
    found = warc.archive_pages(pages(spark, hard_pages())).collect()
    assert sorted(map(tuple, found), key=str) == wanted(hard_pages())


def test_empty_table(spark):
    assert warc.archive_pages(pages(spark, [])).collect() == []


def test_archives_and_indexes(spark, tmp_path):
    folder = f"file://{tmp_path}/out"
    warc.archive_pages(pages(spark, hard_pages()), folder).collect()
    files = sorted((tmp_path / "out").iterdir())
    assert not [f for f in files if "attempt" in f.name]
    records = 0
    for index in (f for f in files if f.suffix == ".idx"):
        archive = index.with_suffix("").read_bytes()
        entries = [json.loads(x) for x in index.read_text().splitlines()]
        assert sum(e["length"] for e in entries) == len(archive)
        for e in entries:
            member = gzip.decompress(archive[e["offset"] : e["offset"] + e["length"]])
            assert member.startswith(b"WARC/1.1\r\n") and member.endswith(b"\r\n\r\n")
        stream = index.with_name(index.name.replace(".warc.gz.idx", ".stream.warc.gz")).read_bytes()
        inflater = zlib.decompressobj(31)
        assert inflater.decompress(stream) == gzip.decompress(archive)
        assert inflater.eof and not inflater.unused_data
        records += len(entries)
    assert records == len(hard_pages())


@pytest.mark.parametrize("size", [1, 7, 100_000])
def test_streams_are_read_in_pieces(size):
    records = [warc.Record({"WARC-Type": "x", "N": str(n)}, b"\r\n\r\n" * n) for n in range(4)]
    data = b"".join(map(warc._bytes, records))
    found = list(warc.stream_records(iter([data[i : i + size] for i in range(0, len(data), size)])))
    assert [r.block for r in found] == [r.block for r in records]
    for short in (data[:-5], data[: len(data) // 2 + 9]):
        with pytest.raises(ValueError):
            list(warc.stream_records(iter([short])))


def test_archives_of_members_can_be_normalised_again(tmp_path):
    record = warc._bytes(warc.Record({"WARC-Type": "warcinfo"}, b"abc"))
    source = tmp_path / "a.stream.warc.gz"
    source.write_bytes(gzip.compress(record * 2) + gzip.compress(record))
    assert warc.normalise_archive(str(source), str(tmp_path / "a.warc.gz")) == 3
    found = list(warc.indexed_records(str(tmp_path / "a.warc.gz"), str(tmp_path / "a.warc.gz.idx")))
    assert [r.block for r in found] == [b"abc"] * 3
