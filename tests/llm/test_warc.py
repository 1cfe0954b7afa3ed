"""WARC archives: the contract against a plain recomputation, the files themselves, damaged and foreign archives."""

import gzip
import hashlib
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest

from tidecast.llm import warc

COLS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def expected(rows):
    groups, out = defaultdict(list), []
    for page, _, html in rows:
        groups[(html or "").encode()].append(page)
    for payload, pages in groups.items():
        pages.sort(key=lambda p: (p is not None, p or 0))
        for i, page in enumerate(pages):
            first = len(payload) < 1000 or i == len(pages) - 1
            out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "response" if first else "revisit", None if first else pages[-1]))
    return Counter(out)


def run(spark, rows, tmp_path, extra=""):
    df = spark.createDataFrame([tuple(r) + (("x", 1) if extra else ()) for r in rows], "page_id long, url string, html string" + extra)
    df.repartition(5).write.parquet(f"{tmp_path}/pages.parquet")
    return Counter(map(tuple, warc.op13_warc_revisits(spark, str(tmp_path)).select(*COLS).collect()))


def test_query_on_given_pages(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r.values()) for r in pq.read_table(f"{d}/pages.parquet", columns=["page_id", "url", "html"]).to_pylist()]
    assert Counter(map(tuple, warc.op13_warc_revisits(spark, d).select(*COLS).collect())) == expected(rows)


def test_copies_repeated_rows_nulls_long_texts_and_clashing_columns(spark, tmp_path):
    big, split = "ä" * 600, "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\n" * 30
    rows = [(i, f"u{i}", big) for i in range(300)] + [(i, None, "small") for i in range(5)] + [(1000 + i, "u", split) for i in range(3)]
    rows += [(77, "same", "y" * 2000)] * 400 + [(76, "same", "y" * 2000), (77, None, "y" * 2000), (77, "other", "y" * 2000)]
    rows += [(None, "u", None), (None, "a\r\nWARC-Type: x", "z" * 1000), (5, "b", "z" * 1000), (None, "u", "w" * 1000), (None, None, "w" * 1000)]
    rows += [(8, "u", "k" * 999)] * 3 + [(9, "u", ""), (9, "u", None), (10, "u", "long " * 400_000), (11, "u", "long " * 400_000)]
    got = run(spark, rows, tmp_path, ", digest string, key long")
    assert got == expected(rows)


def test_empty_table(spark, tmp_path):
    assert run(spark, [], tmp_path) == Counter()


def test_files_hold_each_payload_once_under_fresh_ids(spark, tmp_path):
    rows = [(i, f"http://a/{i}", f"<p>{i % 10}</p>" * 200) for i in range(100)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for mode in ("gzip", "none"):
        warc.write_warc(pages, f"{tmp_path}/{mode}", date="2020-01-01T00:00:00Z", compression=mode)
        data = b"".join((gzip.decompress(p.read_bytes()) if mode == "gzip" else p.read_bytes()) for p in sorted((tmp_path / mode).glob("part-*")))
        found = list(warc.records(data))
        assert len(found) == 100 and data.count(b"<p>3</p>") == 200
        assert len({f["warc-record-id"] for f, _ in found}) == 100
        kinds = Counter(f["warc-type"] for f, _ in found)
        assert kinds == {"response": 10, "revisit": 90}
        revisit = next(f for f, _ in found if f["warc-type"] == "revisit" and f["warc-page-id"] == "13")
        original = next(f for f, _ in found if f["warc-record-id"] == revisit["warc-refers-to"])
        assert original["warc-page-id"] == "93" and revisit["warc-refers-to-target-uri"] == "http://a/93" and revisit["warc-profile"] == warc.PROFILE
        full = {r.page: bytes(r.payload).decode() for r in warc.read_headers(spark, f"{tmp_path}/{mode}", with_payload=True).collect() if r.payload}
        assert full == {i: rows[i][2] for i in range(90, 100)}


def test_reads_archives_of_one_gzip_member_a_record():
    record = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nab\r\nc\r\n\r\n"
    assert [b for _, b in warc.records(gzip.compress(record) * 3)] == [b"ab\r\nc"] * 3


@pytest.mark.parametrize("data", [b"WARC/1.1\r\nContent-Length: 50\r\n\r\nab\r\n\r\n", b"WARC/1.1\r\nContent-", b"GIF89a\r\n\r\n", gzip.compress(b"WARC/1.1\r\n" * 99)[:-20]])
def test_damaged_archives_raise(data):
    with pytest.raises((ValueError, KeyError)):
        list(warc.records(data))


def test_a_revisit_without_its_original_raises(spark):
    heads = spark.createDataFrame([("a", "response", 1, None, "d", None, 3), ("b", "revisit", 2, None, "e", "a", None)],
                                  "record_id string, record_type string, page long, url string, digest string, refers_to string, bytes long")
    with pytest.raises(Exception, match="no original"):
        warc.resolve(heads).collect()
