from __future__ import annotations

import base64
import gzip
import hashlib
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from compare import assert_same, oracle_frame
from tripmill.llm import warc
from tripmill.llm.queries import ORACLES, op13_warc_index

SCHEMA = "page_id long, url string, html string, key string, payload string, offset int, original int, copies int"

ODD = [
    (5, "http://www.Example.com:8080/a?b=c#d", "<p>one</p>"),
    (3, "http://www.example.com:8080/a?b=c#d", "<p>one</p>"),
    (3, "http://www.example.com:8080/a?b=c#d", "<p>one</p>"),
    (None, "http://other.org", "<p>one</p>"),
    (7, None, None),
    (8, "", ""),
    (None, None, "only once"),
    (9, "no scheme/path", "a\r\n\r\nb\r\n\r\nWARC/1.1\r\n"),
    (10, 'line\r\nbreak: "x"  ', "ünïcödé 日本語 😀"),
    (11, '"quoted"', "x" * 300_000),
    (12, "http://h/" + "long" * 500, "x" * 300_000),
    (13, "ftp://user:secret@h.example/", "\x00"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*row, "k", "p", 1, 2, 3) for row in rows], SCHEMA).repartition(3)


def expected(rows, least=0):
    groups = defaultdict(list)
    for page_id, _, html in rows:
        groups[html or ""].append(page_id)
    out = []
    for page_id, url, html in rows:
        data = (html or "").encode()
        ids = [i for i in groups[html or ""] if i is not None]
        revisit = len(data) >= least and ids and page_id != min(ids)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((page_id, url, len(data), digest, "revisit" if revisit else "response", min(ids) if revisit else None))
    return sorted(out, key=repr)


def read(df):
    return sorted((tuple(row)[:6] for row in df.collect()), key=repr)


def test_what_is_written_is_read_back(spark):
    pages = frame(spark, ODD)
    back = warc.archive_pages(spark, pages)
    assert read(back) == expected(ODD)
    texts = {row["page_id"]: bytes(row["payload"]).decode() for row in back.filter("record_type = 'response' AND page_id > 3").collect()}
    assert all(texts[i] == (html or "") for i, _, html in ODD if i in texts) and len(texts) == 5
    assert warc.archive_pages(spark, frame(spark, [])).collect() == []


def test_small_payloads_are_all_responses(spark, tmp_path):
    rows = [(i, f"http://h/{i}", "short" if i % 2 else "long enough") for i in range(10)]
    captures = warc.write_archives(frame(spark, rows), str(tmp_path / "w"), least_bytes=6)
    index = warc.build_index(captures, str(tmp_path / "i"))
    assert read(warc.look_up(index, frame(spark, rows))) == expected(rows, 6)


def test_archives_are_gzip_members_of_bounded_files(spark, tmp_path):
    rows = [(i, f"http://h{i % 7}.example/{i}", f"<p>{i}</p>" * 50) for i in range(200)]
    captures = warc.write_archives(frame(spark, rows), f"file:{tmp_path}/w", archive_bytes=2000)
    files = list(Path(tmp_path / "w").glob("*.warc.gz"))
    assert len(files) > 5 and max(f.stat().st_size for f in files) < 3000
    records = b"".join(gzip.decompress(f.read_bytes()) for f in files)
    assert records.count(b"WARC/1.1\r\n") == 200 and records.endswith(b"\r\n\r\n")
    assert captures.count() == 200


def test_one_url_in_many_blocks_and_single_look_ups(spark, tmp_path):
    rows = [(i, "http://hot.example/" if i % 3 else f"http://h{i}.example/", f"t{i}") for i in range(3000)]
    captures = warc.write_archives(frame(spark, rows), str(tmp_path / "w"))
    index = warc.build_index(captures, str(tmp_path / "i"), block_captures=10)
    assert 300 <= index.blocks <= 310
    assert read(warc.look_up(index, frame(spark, rows))) == expected(rows)
    some = spark.createDataFrame([("http://h6.example/",), ("http://hot.example/",), ("http://none/",)], "url string")
    assert read(warc.look_up(index, some)) == [row for row in expected(rows) if row[1] in ("http://h6.example/", "http://hot.example/")]
    assert warc.look_up(index, some.filter("url = 'http://none/'")).count() == 0


def test_only_the_blocks_of_a_key_are_searched(spark, tmp_path):
    rows = [(i, f"http://h{i:04}.example/", "t") for i in range(1000)]
    captures = warc.write_archives(frame(spark, rows), str(tmp_path / "w"))
    index = warc.build_index(captures, str(tmp_path / "i"), block_captures=20)
    directory = warc._Directory(index.directory)
    assert len(directory.first) == index.blocks >= 50
    assert all(len(list(directory.blocks(f"example,h{i:04})/"))) == 1 for i in range(1000))
    assert list(directory.blocks("a")) == [] and list(directory.blocks("z")) == []


def test_archives_of_dead_tasks_are_not_read(spark, tmp_path):
    rows = [(1, "http://a/", "x"), (2, "http://b/", "y")]
    for _ in range(2):
        captures = warc.write_archives(frame(spark, rows), str(tmp_path / "w"))
    index = warc.build_index(captures, str(tmp_path / "i"))
    assert read(warc.look_up(index, frame(spark, rows))) == expected(rows)


def test_a_changed_payload_is_noticed():
    digest = base64.b32encode(hashlib.sha1(b"abc").digest()).decode()
    data = warc.record(1, "u", b"abc", None, 3, digest, "d")
    assert warc.parse_record(data)[:3] == (1, "u", 3)
    with pytest.raises(ValueError, match="headers say"):
        warc.parse_record(data.replace(b"abc", b"abd"))


@pytest.mark.parametrize(
    ("url", "key"),
    [
        ("http://www.example.com/a", "com,example,www)/a"),
        ("HTTPS://Example.COM:8080/A?b#c", "com,example:8080)/A?b#c"),
        ("example.com", "com,example)"),
        (None, ""),
        ("", ")"),
        ("http://u:p@h.example?q", "example,h)?q"),
    ],
)
def test_keys(spark, url, key):
    df = spark.createDataFrame([(url,)], "url string")
    assert df.select(warc.capture_key(F.col("url"))).first()[0] == key


def test_same_as_the_oracle(spark, small):
    assert_same(op13_warc_index(spark, small), oracle_frame(small, ORACLES["op13_warc_index"]))
