"""Archives: framing, segments, exact round trips, and what is done with broken ones."""

from __future__ import annotations

import collections
import glob
import gzip
import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from pluvia.llm import warc
from pluvia.llm.op_queries import op12_warc
from pluvia.operators import joins
from pluvia.session import scratch_path

from .conftest import page_rows


def expected(rows):
    """(page_id, bytes, digest, type, refers_to) of every row."""
    groups = collections.defaultdict(list)
    for i, u, h in rows:
        groups[(h or "").encode()].append((i is not None, i or 0, u is not None, u or "", i))
    out = []
    for payload, members in groups.items():
        first = max(members)
        for k, m in enumerate(sorted(members, reverse=True)):
            again = k > 0 and len(payload) >= 1000
            out.append((m[-1], len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", first[-1] if again else None))
    return collections.Counter(out)


def found(df):
    return collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect())


def test_query(spark, sf_dir):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    got = found(op12_warc(spark, sf_dir))
    assert got == expected(rows)
    assert sum(n for r, n in got.items() if r[3] == "revisit") == 8


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


@pytest.mark.parametrize("options", [{"segment_bytes": 7, "chunk_bytes": 3}, {"segment_bytes": 1000, "chunk_bytes": 1}, {"min_revisit": 0}])
def test_payloads_survive_any_cutting(spark, options):
    rows = [r for r in page_rows() if not r[2] or len(r[2]) < 20_000]
    path = scratch_path(spark, "archives")
    warc.write_archives(pages(spark, rows), path, **options)
    got = warc.read_archives(spark, path, payloads=True).collect()
    assert {r.status for r in got} == {"complete"} and len(got) == len(rows)
    texts = {(h or "").encode() for _, _, h in rows}
    assert {bytes(r.payload) for r in got if r.kind == "response"} == texts
    assert collections.Counter(r.page_id for r in got) == collections.Counter(i for i, _, _ in rows)


def test_hot_payload_and_joins_beyond_a_broadcast(spark, monkeypatch):
    """Two thirds of the rows share one payload, and no side of a join may be broadcast."""
    rows = [(i, "u", "p" * 1500) for i in range(600)] + [(1000 + i, "u", f"{i} " * 700) for i in range(300)]
    monkeypatch.setattr(warc, "lookup_join", lambda *a, **b: joins.lookup_join(*a, broadcast_bytes=0, **b))
    got = warc.round_trip(pages(spark, rows)).withColumnRenamed("kind", "record_type")
    assert found(got) == expected(rows)


def test_files_are_archives(spark):
    path = scratch_path(spark, "archives")
    warc.write_archives(pages(spark, [(1, "http://a/é b", "t" * 300), (2, None, "t" * 1200), (3, "x", "t" * 1200)]), path, segment_bytes=500)
    data = b"".join(gzip.open(f).read() for f in glob.glob(f"{path}/*.gz"))
    parts = data.split(b"WARC/1.1\r\n")[1:]
    fields = [dict(line.split(": ", 1) for line in p.split("\r\n\r\n")[0].split("\r\n")) for p in (x.decode() for x in parts)]
    assert collections.Counter(f["WARC-Type"] for f in fields) == {"response": 2, "revisit": 1, "continuation": 2}
    for p, f in zip(parts, fields, strict=True):
        assert len(p.split(b"\r\n\r\n", 1)[1]) == int(f["Content-Length"]) + 4 and p.endswith(b"\r\n\r\n")
    last = [f for f in fields if "WARC-Segment-Total-Length" in f]
    assert len(last) == 1 and last[0]["WARC-Segment-Number"] == "3"
    assert "http://a/é%20b" in {f.get("WARC-Target-URI") for f in fields}
    assert len({f["WARC-Record-ID"] for f in fields}) == 5


def archive(spark, tmp_path, *records):
    """Records as a file compressed one by one, as crawlers write it."""
    with open(tmp_path / "a.warc.gz", "wb") as out:
        for r in records:
            out.write(gzip.compress(r + b"\r\n\r\n"))
    return {r.record_id: r for r in warc.read_archives(spark, str(tmp_path), payloads=True).collect()}


def test_foreign_and_broken_archives(spark, tmp_path):
    http = warc.HEAD + b"Transfer-Encoding: chunked\r\n\r\n"
    whole = http + b"3;x=y\r\nabc\r\n2\r\nde\r\n0\r\nTrailer: 1\r\n\r\n"
    part = lambda i, n, b, total=None: warc.record("continuation" if n > 1 else "response", b, WARC_Record_ID=i if n == 1 else f"{i}{n}", WARC_Segment_Origin_ID=i if n > 1 else None, WARC_Segment_Number=n, WARC_Segment_Total_Length=total)
    sha = hashlib.sha1(b"abcde").hexdigest()
    got = archive(
        spark, tmp_path,
        warc.record("warcinfo", b"software: x\r\n\r\n", WARC_Record_ID="info"),
        part("a", 2, whole[40:60]), part("a", 3, whole[60:], len(whole)), part("a", 1, whole[:40]), part("a", 2, whole[40:60]),
        part("gap", 1, whole[:40]), part("gap", 3, whole[60:], len(whole)),
        part("short", 1, whole[:40]), part("short", 2, whole[40:], len(whole) + 1),
        part("open", 1, whole[:40]), part("open", 2, whole[40:]),
        part("orphan", 2, whole, len(whole)),
        warc.record("response", whole, WARC_Record_ID="one", WARC_Payload_Digest=f"sha1:{sha}"),
        warc.record("response", whole, WARC_Record_ID="wrong", WARC_Payload_Digest="sha1:" + "A" * 32),
        warc.record("response", http + b"zz\r\nabc", WARC_Record_ID="frame"),
        warc.record("response", b"HTTP/1.0 200 OK\r\n\r\nraw\r\n\r\n", WARC_Record_ID="raw"),
        warc.record("revisit", b"", WARC_Record_ID="r1", WARC_Refers_To="one", WARC_Payload_Digest=f"sha1:{sha}"),
        warc.record("revisit", b"", WARC_Record_ID="r2", WARC_Refers_To="one", WARC_Payload_Digest="sha1:" + "A" * 32),
        warc.record("revisit", b"", WARC_Record_ID="r3", WARC_Refers_To="nowhere"),
        warc.record("revisit", b"", WARC_Record_ID="r4", WARC_Refers_To="gap"),
    )
    status = {k: r.status for k, r in got.items()}
    assert {k for k, s in status.items() if s == "complete"} == {"a", "one", "raw", "r1"}
    assert {k for k, s in status.items() if s == "incomplete"} == {"gap", "short", "open", "orphan", "r3", "r4"}
    assert {k for k, s in status.items() if s == "damaged"} == {"wrong", "frame", "r2"}
    assert bytes(got["a"].payload) == b"abcde" and bytes(got["raw"].payload) == b"raw\r\n\r\n"
    assert got["r1"].payload_digest == sha and got["r1"].payload_bytes == 5 and got["gap"].payload_bytes is None


def test_record_cut_off_by_the_end_of_its_file(spark, tmp_path):
    one = warc.record("response", b"HTTP/1.0 200 OK\r\n\r\nabc", WARC_Record_ID="one") + b"\r\n\r\n"
    for name, data in (("a", one.replace(b"one", b"cut")[:-9]), ("b", one)):
        (tmp_path / f"{name}.warc.gz").write_bytes(gzip.compress(data))
    got = {r.record_id: r.status for r in warc.read_archives(spark, str(tmp_path)).collect()}
    assert got == {"cut": "incomplete", "one": "complete"}


@given(st.binary(max_size=300), st.integers(1, 40))
def test_chunked_framing(payload, size):
    assert warc.unchunked(warc.chunked(payload, size)) == payload
    assert warc.unchunked(warc.chunked(payload, size)[:-1]) is None


@given(st.lists(st.tuples(st.binary(max_size=60), st.text(max_size=8)), max_size=6), st.integers(1, 30))
def test_parser_takes_any_pieces(records, size):
    data = b"".join(warc.record("response", b, WARC_Record_ID="".join(c for c in i if c.isalnum())) + b"\r\n\r\n" for b, i in records)
    parser = warc.Parser()
    got = [block for k in range(0, len(data), size) for _, block in parser.feed(data[k : k + size])]
    assert got == [b for b, _ in records] and parser.rest() is None
