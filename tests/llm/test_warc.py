"""Archives: written, read back and held against the rows they came from."""

import base64
import gzip
import hashlib
import json
import os

import pytest

from visitlens.llm import warc

from .conftest import SF

SCHEMA = "page_id long, url string, html string"
HOT = "<p>the same page</p>" * 40


def rows():
    some = [(i, f"http://a.example/{i}", f"<p>page {i % 60} {'x' * (i % 7) * 900}</p>") for i in range(200)]
    return some + [(300, None, None), (301, "", ""), (302, "http://b.example/ü ö\r\nX: y", "été 漢字 \U0001f600"), (303, "u", "WARC/1.1\r\n\r\n"),
                   (None, "n", "only nobody's"), (None, "n", "only nobody's"), (None, "n", HOT), (5, "other url", "<p>page 5 " + "x" * 4500 + "</p>"),
                   (304, "big", "z" * 3_000_000)] + [(400 + i, "hot", HOT) for i in range(150)] + [(400, "hot", HOT)] * 3


def brute(table):
    first = {}
    for i, _, html in table:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, _, html in table:
        data = (html or "").encode()
        least = first.get(html or "")
        again = least is not None and i != least
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if again else "response", least if again else None))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_table_against_brute_force(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = warc.archive_report(pages)
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert got(found) == brute([(r["page_id"], r["url"], r["html"]) for r in pages.collect()])


def test_edge_rows_and_clashing_columns(spark):
    extra = [(*r, 1, "s", 2, b"p", 3) for r in rows()]
    df = spark.createDataFrame(extra, SCHEMA + ", shard int, sha1 string, first long, payload binary, size long").repartition(7)
    assert got(warc.archive_report(df)) == brute(rows())
    assert got(warc.archive_report(spark.createDataFrame([], SCHEMA))) == []


def folder_of(tmp_path, name):
    return f"file://{tmp_path}/{name}"


def files(folder):
    data = folder.removeprefix("file://") + "/data"
    return {n: open(f"{data}/{n}", "rb").read() for n in sorted(os.listdir(data))}


def test_files_are_the_same_whatever_the_partitions(spark, tmp_path):
    a = warc.write_warc(spark.createDataFrame(rows(), SCHEMA).repartition(3), folder_of(tmp_path, "a"), roll_bytes=4000, min_shards=5)
    b = warc.write_warc(spark.createDataFrame(rows()[::-1], SCHEMA).repartition(11), folder_of(tmp_path, "b"), roll_bytes=4000, min_shards=5)
    assert files(a) == files(b) and len(files(a)) > 5
    lines = [json.loads(x) for x in open(a.removeprefix("file://") + "/manifest.jsonl")]
    assert [x["file"] for x in lines] == sorted(files(a)) and sum(x["records"] for x in lines) == len(rows())
    for line in lines:  # a file ends with the record that reaches the limit
        data = files(a)[line["file"]]
        assert line["bytes"] == len(data) and line["sha256"] == hashlib.sha256(data).hexdigest()
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
    assert len({x["shard"] for x in lines}) > 1


def test_payloads_come_back(spark, tmp_path):
    folder = warc.write_warc(spark.createDataFrame(rows(), SCHEMA), folder_of(tmp_path, "c"), min_shards=3)
    back = warc.read_warc(spark, folder).collect()
    texts = {(i, (h or "").encode()) for i, _, h in rows()}
    assert {(r["page_id"], bytes(r["payload"])) for r in back if r["record_type"] == "response"} <= texts
    ids = {r["record_id"]: r for r in back}
    assert len(ids) == len(back) == len(rows())
    for r in back:  # what a revisit refers to is a response of that page with that digest
        if r["record_type"] == "revisit":
            to = ids[r["refers_to_record"]]
            assert (to["record_type"], to["page_id"], to["payload_digest"]) == ("response", r["refers_to"], r["payload_digest"])
    assert {r["url"] for r in back if r["page_id"] == 302} == {"http://b.example/%C3%BC%20%C3%B6%0D%0AX:%20y"}


def test_short_payloads_are_all_responses(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "a", HOT), (4, "a", HOT)], SCHEMA)
    folder = warc.write_warc(df, folder_of(tmp_path, "d"), least=2)
    assert {r["page_id"]: r["record_type"] for r in warc.read_warc(spark, folder).collect()} == \
        {1: "response", 2: "response", 3: "response", 4: "revisit"}


def test_files_outside_the_manifest_do_not_count(spark, tmp_path):
    """Leftovers of lost attempts are removed at the commit and never read."""
    folder = folder_of(tmp_path, "e")
    os.makedirs(f"{tmp_path}/e/data")
    open(f"{tmp_path}/e/data/shard-000000-00000.warc.gz.tmp-lost", "wb").write(b"half a file")
    df = spark.createDataFrame(rows()[:20], SCHEMA)
    warc.write_warc(df, folder)
    assert not [n for n in files(folder) if "tmp" in n] and not [n for n in os.listdir(f"{tmp_path}/e") if "tmp" in n]
    open(f"{tmp_path}/e/data/stray.warc.gz", "wb").write(b"not ours")
    assert warc.read_warc(spark, folder).count() == 20


def test_damage_is_an_error(spark, tmp_path):
    folder = warc.write_warc(spark.createDataFrame(rows()[:9], SCHEMA), folder_of(tmp_path, "f"), min_shards=1)
    name, data = next(iter(files(folder).items()))
    open(f"{tmp_path}/f/data/{name}", "wb").write(data[:-40])
    with pytest.raises(Exception, match="not the size in the manifest"):
        warc.read_warc(spark, folder).count()


def test_records_of_a_stream():
    records = [warc.page_record(1, "u", b"abc" * 100, None, False, 0), warc.page_record(2, None, b"", 1, True, 0)]

    class Slow:  # a stream that gives a few bytes at a time
        def __init__(self, data):
            self.data = data

        def read(self, n):
            out, self.data = self.data[:7], self.data[7:]
            return out

    whole = b"".join(map(warc.member, records))
    assert list(warc.members(Slow(whole), "w")) == records
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.members(Slow(whole[:-9]), "w"))
    with pytest.raises(ValueError, match="damaged"):
        warc.parse_record(records[0].replace(b"abcabc", b"abcabd", 1), "w")
