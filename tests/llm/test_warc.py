import hashlib
import io
import zipfile

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from patchlens.llm import warc as W
from patchlens.llm.common import shared_folder

SCHEMA = "page_id long, url string, html string"
BIG = "<p>" + "x" * 120


def pages():
    return [(5, "http://a/ü?q=1 2", BIG), (2, None, BIG), (9, "http://b/\r\nX: y", BIG), (1, "http://c", "small"), (3, "http://c", "small"),
            (4, "http://d", None), (6, "http://d", ""), (7, "u", "é" * 49), (8, "u", "é" * 50), (10, "u", "é" * 50),
            (None, "n", BIG), (None, "n", "<b>alone" + "z" * 200), (11, "u", "\r\n\r\n" * 60), (12, "u", "w" * 3_000_000)]


def want(rows):
    groups = {}
    for i, _, html in rows:
        p = (html or "").encode()
        if len(p) >= 100 and i is not None:
            groups[p] = min(i, groups.get(p, i))
    out = []
    for i, _, html in rows:
        p = (html or "").encode()
        first = groups.get(p, i) if len(p) >= 100 else i
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "response" if first == i else "revisit", None if first == i else first))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("archive_bytes", [1, 300, W.ARCHIVE_BYTES])
def test_round_trip(spark, archive_bytes):
    df = spark.createDataFrame(pages(), SCHEMA).withColumn("first", F.lit("x")).withColumn("payload", F.lit(0)).repartition(2)
    folder = shared_folder(spark, "warc-test")
    manifest = W.write_archives(df, folder, archive_bytes)
    assert manifest.agg(F.sum("records")).first()[0] == len(pages())
    assert got(W.read_archives(manifest, folder)) == want(pages())
    W.drop_archives(folder)


def test_repeated_rows_and_empty_table(spark):
    folder = shared_folder(spark, "warc-test")
    twice = spark.createDataFrame([(1, "u", BIG), (1, "u", BIG), (2, "u", BIG)], SCHEMA)
    rows = got(W.read_archives(W.write_archives(twice, folder), folder))
    assert [(r[0], r[3], r[4]) for r in rows] == [(1, "response", None), (1, "response", None), (2, "revisit", 1)]
    none = W.write_archives(twice.limit(0), folder)
    assert none.collect() == [] and W.read_archives(none, folder).collect() == []


def test_archives_are_valid_zip_files_of_stored_members(spark):
    folder = shared_folder(spark, "warc-test")
    manifest = W.write_archives(spark.createDataFrame(pages(), SCHEMA).coalesce(1), folder).collect()
    store, _ = W.open_store(folder)
    assert isinstance(store, fs.LocalFileSystem)
    with zipfile.ZipFile(manifest[0]["path"]) as z:
        assert z.testzip() is None
        assert [(i.filename, i.compress_type) for i in z.infolist()] == [(W.ARCHIVE_MEMBER, 0), (W.INDEX_MEMBER, 0)]
        import gzip

        text = gzip.decompress(z.read(W.ARCHIVE_MEMBER))
    assert text.count(b"WARC/1.1\r\n") == len(pages()) and text.count(b"WARC-Type: revisit") == sum(w[3] == "revisit" for w in want(pages()))


def members_of(data):
    return W.zip_members(lambda at, n: data[at: at + n], len(data)), lambda m: W.stored_at(lambda at, n: data[at: at + n], m)


def test_directory_parser_on_zip64_and_comments(monkeypatch):
    for limit in (None, 0):  # with a limit of 0 the writer saturates every field and adds the ZIP64 records
        if limit is not None:
            monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
            monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", limit)
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as z:
            for i in range(300):
                z.writestr(f"dir/ü{i}", bytes([i % 256]) * i)
            z.comment = b"PK\x05\x06 not the end record"
        data = b"junk" * 0 + buf.getvalue()
        found, at = members_of(data)
        assert (b"PK\x06\x07" in data) == (limit == 0)
        assert len(found) == 300
        for i in (0, 1, 17, 299):
            m = found[f"dir/ü{i}"]
            assert m["size"] == m["packed"] == i and data[at(m): at(m) + i] == bytes([i % 256]) * i


def test_broken_archives_raise():
    with pytest.raises(ValueError):
        members_of(b"no zip at all")
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", b"x" * 1000)
    found, at = members_of(buf.getvalue())
    with pytest.raises(ValueError):
        at(found["a"])
    record = W.warc_record(1, "u", b"abc", hashlib.sha256(b"abc").hexdigest(), None)
    assert W.parse_record(record)["payload_bytes"] == 3
    with pytest.raises(ValueError):
        W.parse_record(record.replace(b"abc", b"abd"))
