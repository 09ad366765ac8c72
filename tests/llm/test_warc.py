"""Archives: round trips, the normaliser, and the query against brute force."""

import gzip
import hashlib
import io
import json
import zlib

import pytest

from tagloom.llm import queries, warc

FOLDER = "/root/testdata/sf0.001"

LONG, LARGE = "<p>" + "x" * 200, "é🙂\r\n\r\nWARC/1.1\r\n" * 200_000
PAGES = [
    (3, "http://a/1", LONG), (1, "http://a/2", LONG), (2, None, LONG), (4, "u", "x" * 99), (5, "u", "x" * 99), (6, "u", "x" * 100),
    (7, "u", "x" * 100), (8, "u", None), (9, "u", ""), (10, "a\r\nWARC-Type: evil\r\n\r\n", LARGE), (11, "http://é/", "é" * 50),
    (12, "u", "é" * 50), (None, "n", LONG), (None, "n", "y" * 100), (None, "n", "y" * 100), (1, "again", LONG), (13, "u", "\x00\x1f" * 60),
]


def brute(pages):
    first = {}
    for key, _, html in pages:
        raw = (html or "").encode()
        if len(raw) >= 100 and key is not None:
            first[raw] = min(key, first.get(raw, key))
    out = []
    for key, _, html in pages:
        raw = (html or "").encode()
        other = first.get(raw)
        refers = other if other is not None and other != key else None
        out.append((key, len(raw), hashlib.sha256(raw).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def table(spark, pages):
    rows = [(*page, 1, b"x") for page in pages]
    return spark.createDataFrame(rows, "page_id long, url string, html string, n int, payload binary")


def test_round_trip(spark, tmp_path):
    rows = warc.archived(spark, table(spark, PAGES).repartition(3), str(tmp_path)).collect()
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(found, key=str) == brute(PAGES)
    texts = {(key, (html or "").encode()) for key, _, html in PAGES}
    for row in rows:
        assert (row.payload is None) == (row.record_type == "revisit")
        assert row.payload is None or (row.page_id, bytes(row.payload)) in texts
    assert {row.url for row in rows if row.page_id == 10} == {"a%0D%0AWARC-Type: evil%0D%0A%0D%0A"}


def test_archives_are_small_members_at_their_offsets(spark, tmp_path):
    warc.archived(spark, table(spark, PAGES).coalesce(1), f"file://{tmp_path}", archive_bytes=1000).collect()
    raw = sorted((tmp_path / "raw").glob("*.warc.gz"))
    assert len(raw) > 3
    n = 0
    for path in (tmp_path / "archives").glob("*.warc.gz"):
        data, end = path.read_bytes(), 0
        for line in (path.parent / f"{path.name}.index").read_text().splitlines():
            entry = json.loads(line)
            assert entry["offset"] == end
            end += entry["length"]
            member = gzip.decompress(data[entry["offset"] : end])
            assert member.startswith(b"WARC/1.1\r\n") and member.endswith(b"\r\n\r\n")
            assert member.count(b"WARC-Record-ID: " + entry["warc-record-id"].encode()) == 1
            n += 1
        assert end == len(data)
    assert n == len(PAGES)


def test_query_on_a_whole_table(spark):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()]
    rows = queries.op7_warc(spark, FOLDER).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows], key=str) == brute(pages)


def test_no_pages(spark, tmp_path):
    assert warc.archived(spark, table(spark, []), str(tmp_path)).collect() == []


RECORDS = [warc.page_record(n, "u", body, len(body), hashlib.sha256(body).hexdigest(), None, "d") for n, body in
           enumerate([b"", b"a" * 300_000, b"\r\n\r\nWARC/1.1\r\n\r\n", b"z"])]


@pytest.mark.parametrize("members", [1, 2, 4])
def test_any_members_become_one_per_record(members):
    step = len(RECORDS) // members
    source = b"".join(gzip.compress(b"".join(RECORDS[at : at + step])) for at in range(0, len(RECORDS), step))
    target = io.BytesIO()
    index = list(warc.normalise(io.BytesIO(source), target))
    assert [zlib.decompress(target.getvalue()[e["offset"] : e["offset"] + e["length"]], 31) for e in index] == RECORDS


def test_a_member_may_end_inside_a_record():
    joined = b"".join(RECORDS)
    source = gzip.compress(joined[:150_000]) + gzip.compress(joined[150_000:])
    assert len(list(warc.normalise(io.BytesIO(source), io.BytesIO()))) == len(RECORDS)


def test_cut_off_and_foreign_streams_are_refused():
    whole = gzip.compress(b"".join(RECORDS))
    with pytest.raises(EOFError):
        list(warc.normalise(io.BytesIO(whole[: len(whole) // 2]), io.BytesIO()))
    with pytest.raises(EOFError):
        list(warc.normalise(io.BytesIO(gzip.compress(RECORDS[1][:-50_000])), io.BytesIO()))
    with pytest.raises(ValueError):
        list(warc.normalise(io.BytesIO(gzip.compress(b"GET / HTTP/1.1\r\n\r\n")), io.BytesIO()))


def test_damaged_payload_is_noticed(spark, tmp_path):
    raw = warc.write_raw(table(spark, PAGES[:1]), f"{tmp_path}/raw")
    archives = warc.normalise_archives(raw, f"{tmp_path}/raw", f"{tmp_path}/archives")
    (path,) = (tmp_path / "archives").glob("*.warc.gz")
    text = gzip.decompress(path.read_bytes())
    damaged = gzip.compress(text.replace(b"<p>x", b"<q>x"))
    path.write_bytes(damaged)
    index = path.parent / f"{path.name}.index"
    index.write_text(json.dumps(json.loads(index.read_text()) | {"length": len(damaged)}) + "\n")
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_archives(archives, f"{tmp_path}/archives").collect()
