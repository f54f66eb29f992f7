"""Bundles: every record read back, revisits, random access, public readers."""

import base64
import hashlib
import os

import zstandard
from pyspark.sql import functions as F

from fichario.llm import warc
from fichario.llm.catalog import op8_warc

PAGES = "page_id long, url string, html string, path string"


def slow(rows):
    first = {}
    for page_id, _, html, *_ in rows:
        if page_id is not None:
            first[html or ""] = min(first.get(html or "", page_id), page_id)
    out = []
    for page_id, _, html, *_ in rows:
        data = (html or "").encode()
        refers = first.get(html or "")
        refers = None if page_id is None or refers == page_id else refers
        out.append((page_id, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def test_whole_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html").collect()
    found = op8_warc(spark, folder)
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, found.collect()), key=str) == slow(rows)


def test_copies_nulls_ties_and_access(spark):
    rows = [(5, "u", "same"), (3, "u", "same"), (3, "u", "same"), (9, None, None), (8, "x\r\ny: z", ""),
            (None, "u", "same"), (7, "v" * 9000, "é\r\n\r\nWARC/1.1" * 5000), (3, "w", "other"), (11, "w", "other")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], PAGES)
    index = warc.write(pages, frame_bytes=1000)
    assert index.count() == len(rows)
    found = warc.read(index).drop("url").collect()
    assert sorted(map(tuple, found), key=str) == slow(rows)
    wanted = spark.createDataFrame([(5,), (9,), (7,), (11,), (404,)], "page_id long")
    got = {r.page_id: r.html for r in warc.fetch(index, wanted).collect()}
    assert got == {5: "same", 9: "", 7: rows[6][2], 11: "other"}
    for r in index.select("path").distinct().collect():
        path = r.path.removeprefix("file:")
        with open("/" + path.lstrip("/"), "rb") as file:
            plain = zstandard.ZstdDecompressor().stream_reader(file, read_across_frames=True).read()
        assert plain.startswith(b"WARC/1.1\r\n") and os.path.getsize("/" + path.lstrip("/")) > 17


def test_empty_table(spark):
    pages = spark.createDataFrame([], PAGES)
    index = warc.write(pages)
    assert index.count() == 0 and warc.read(index).count() == 0
    assert warc.fetch(index, pages.select("page_id")).count() == 0


def test_many_copies_stay_one_row_each(spark):
    pages = spark.range(3000).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"), F.lit("copy").alias("html"))
    kinds = {r.record_type: r["count"] for r in warc.read(warc.write(pages)).groupBy("record_type").count().collect()}
    assert kinds == {"response": 1, "revisit": 2999}
