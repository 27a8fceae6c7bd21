import collections
import gzip
import hashlib
import io
import json
import zipfile

import pytest

from leadwright.llm import tools, warc_zip


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def facts(spark, df, **options):
    archives = warc_zip.write_archives(df, **options)
    return archives, collections.Counter(tuple(r) for r in warc_zip.payload_facts(warc_zip.read_records(archives, 5_000)).collect())


def brute(rows):
    last = {}
    for page, _, html in rows:
        if len((html or "").encode()) >= 1000 and page is not None:
            last[html] = max(last.get(html, page), page)
    out = []
    for page, _, html in rows:
        data, first = (html or "").encode(), last.get(html)
        revisit = first is not None and page != first
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return collections.Counter(out)


def test_given_pages_come_back_byte_by_byte(spark, small):
    df = tools.documents(spark, small, "pages")
    archives = warc_zip.write_archives(df, archive_bytes=20_000)
    assert archives.count() > 3
    got = {r["page_id"]: (r["uri"], bytes(r["payload"])) for r in warc_zip.read_records(archives, 3_000).collect()}
    assert got == {r["page_id"]: (r["url"], r["html"].encode()) for r in df.collect()}


def test_copies_become_revisits(spark):
    big, other = "<p>é</p>" * 300, "x" * 1000
    rows = [(i, f"http://h/{i}", big) for i in range(40)] + [(100, "http://h/a", other), (50, None, other), (51, "u", "y" * 999), (52, "u", "y" * 999)]
    rows += [(60, "u", None), (61, "u", ""), (100, "http://h/a", other), (None, "u", other), (None, None, None), (70, "line\r\nbreak", "z")]
    df = pages(spark, rows).selectExpr("*", "1 AS payload", "2 AS digest", "3 AS first", "4 AS path").repartition(3)
    assert facts(spark, df)[1] == brute(rows)


def test_empty_table(spark):
    archives, found = facts(spark, pages(spark, []))
    assert archives.count() == 0 and not found


def test_archives_of_another_writer(spark, tmp_path):
    records = [warc_zip.record_bytes(i, f"http://h/{i}", f"text {i}".encode() * 50, hashlib.sha1(f"text {i}".encode() * 50).hexdigest()) for i in range(20)]
    packed = [gzip.compress(r) for r in records]
    index = "".join("com,h)/ 2024 " + json.dumps({"offset": str(sum(map(len, packed[:i]))), "filename": "data.warc.gz"}) + "\n" for i in range(20))
    for name, data, with_index in (("a.wacz", b"".join(packed), True), ("b.wacz", b"".join(packed), False), ("c.wacz", b"".join(records), False)):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            z.writestr("datapackage.json", "{}", zipfile.ZIP_DEFLATED)
            z.writestr("archive/data.warc" + ".gz" * (name != "c.wacz"), data, zipfile.ZIP_STORED)
            if with_index:
                z.writestr("indexes/index.cdx.gz", gzip.compress(index.encode()), zipfile.ZIP_STORED)
            z.comment = b"a comment"
        found = warc_zip.read_records(spark.createDataFrame([(str(tmp_path / name),)], "path string"), 500).collect()
        assert sorted((r["page_id"], bytes(r["payload"])) for r in found) == [(i, f"text {i}".encode() * 50) for i in range(20)]


def test_zip64_fields_are_followed():
    data = warc_zip.zip64_bytes([("archive/x.warc", b"abc" * 10), ("indexes/i.cdxj", b"k")])
    members = warc_zip.zip_members(io.BytesIO(data), len(data))
    assert {n: data[m["start"]:m["start"] + m["full"]] for n, m in members.items()} == {"archive/x.warc": b"abc" * 10, "indexes/i.cdxj": b"k"}
    with zipfile.ZipFile(io.BytesIO(data)) as z:  # and the writer's archives are what others read
        assert z.testzip() is None and z.read("archive/x.warc") == b"abc" * 10


def test_damage_is_reported(spark, tmp_path):
    record = warc_zip.record_bytes(1, "u", b"payload", hashlib.sha1(b"other").hexdigest())
    (tmp_path / "x.wacz").write_bytes(warc_zip.zip64_bytes([("archive/data.warc", record)]))
    with pytest.raises(Exception, match="does not have its digest"):
        warc_zip.read_records(spark.createDataFrame([(str(tmp_path / "x.wacz"),)], "path string")).collect()
    with pytest.raises(ValueError, match="not a ZIP"):
        warc_zip.zip_members(io.BytesIO(b"no archive"), 10)
