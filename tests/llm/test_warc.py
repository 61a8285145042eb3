import gzip
import hashlib
import io
import json
import random
import zlib

import pytest

from tabeval.llm import warc

SCHEMA = "page_id bigint, url string, html string, payload string, digest int, first string"


def frame(spark, pages):
    return spark.createDataFrame([(p, u, h, "x", 1, "y") for p, u, h in pages], SCHEMA)


def corpus():
    rng = random.Random(7)
    pages = [(100 - i, f"http://h/{i}", "".join(rng.choice("aé\r\n <>WARC/1.1") for _ in range(rng.choice([0, 5, 99, 100, 400])))) for i in range(40)]
    pages += [(200 + i, f"http://copy/{i}", pages[i][2]) for i in range(0, 40, 3)]
    return pages + [(300, None, None), (301, "http://x/\r\nInjected: yes", ""), (302, "u", "z" * 300_000), (303, "u", "z" * 300_000), (None, "u", "n" * 200)]


def plain(pages):
    first = {}
    for page, _, html in pages:
        body = (html or "").encode()
        if len(body) >= 100 and page is not None:
            first[body] = min(first.get(body, page), page)
    out = []
    for page, _, html in pages:
        body = (html or "").encode()
        again = page is not None and first.get(body, page) != page
        out.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first[body] if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("file_bytes, chunk", [(64 << 20, 1 << 20), (2000, 37)])
def test_round_trip(spark, tmp_path, monkeypatch, file_bytes, chunk):
    monkeypatch.setattr(warc, "FILE_BYTES", file_bytes)
    monkeypatch.setattr(warc, "CHUNK", chunk)
    pages = corpus()
    loose = warc.write_archives(frame(spark, pages).repartition(3), f"file://{tmp_path}/loose")
    done = warc.normalise(loose, f"file://{tmp_path}/members")
    reread = warc.read_archives(done)
    assert reread.rdd.getNumPartitions() == done.count()  # a task an archive, however short the table of archives is
    got = reread.collect()
    assert sorted([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got], key=str) == plain(pages)
    texts = {p: (h or "").encode() for p, _, h in pages}
    assert all(bytes(r["payload"]) == texts[r["page_id"]] for r in got if r["record_type"] == "response")
    for row in done.collect():
        raw, whole = open(row["path"][7:], "rb").read(), b""
        entries = [json.loads(line) for line in open(row["index"][7:])]
        assert [e["offset"] for e in entries[1:]] == [e["offset"] + e["length"] for e in entries[:-1]] and len(raw) == entries[-1]["offset"] + entries[-1]["length"]
        for e in entries:
            part = zlib.decompress(raw[e["offset"] : e["offset"] + e["length"]], 31)
            assert part.startswith(b"WARC/1.1\r\n") and part.endswith(b"\r\n\r\n") and b"\r\nInjected" not in part
            whole += part
        assert gzip.decompress(raw) == whole  # still one valid gzip file


def test_streams_of_one_and_of_many_members_and_broken_ones(monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 11)
    data = [b"first " * 50, b"", b"second"]
    many = b"".join(gzip.compress(d) for d in data)
    assert b"".join(warc.inflated(io.BytesIO(many))) == b"".join(data)
    assert b"".join(warc.inflated(io.BytesIO(gzip.compress(b"".join(data))))) == b"".join(data)
    with pytest.raises(ValueError):
        list(warc.inflated(io.BytesIO(many[:-30])))
    record = warc.record("response", 1, "u", b"body", "d", 4, None, warc.DATE)
    for cut in (10, len(record) - 6, len(record) - 1):
        with pytest.raises(ValueError):
            for _, block in warc.split_records(iter([record[:cut]])):
                list(block)


def test_repeated_rows_and_empty_tables(spark):
    pages = [(1, "u", "a" * 150), (1, "u", "a" * 150), (2, "u", "a" * 150), (3, "u", "short"), (4, "u", "short")]
    got = warc.archived(frame(spark, pages)).collect()
    assert sorted((r["page_id"], r["record_type"], r["refers_to"] or 0) for r in got) == [(1, "response", 0), (1, "response", 0), (2, "revisit", 1), (3, "response", 0), (4, "response", 0)]
    assert warc.archived(frame(spark, [])).collect() == []
