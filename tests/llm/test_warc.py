import hashlib
import io
import os

import zstandard

from telemetra.llm import warc


def pages(spark):
    rows = [(i, f"http://h/{i}", f"<p>page {i}</p>" * (i % 9)) for i in range(200)]
    rows += [(300 + i, f"http://copy/{i}", "<p>the same page</p>" * 20) for i in range(120)]
    rows += [(500, None, None), (501, "http://x/\r\nWARC-Type: evil", "ü" * 300), (502, "http://big/", "long " * 400_000), (503, "u", "<p>the same page</p>" * 20)]
    rows += [(None, "http://none/", "<p>the same page</p>" * 20), (None, "http://none/", "short"), (300, "http://copy/0", "<p>the same page</p>" * 20), (2**62 + 1, "u", "\r\n\r\nodd"), (299, "z", "<p>the same page</p>" * 20)]
    return rows, spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")


def expected(rows):
    data = [(i, (h or "").encode()) for i, _, h in rows]
    result = []
    for i, payload in data:
        first = min((j for j, other in data if other == payload and j is not None), default=None)
        revisit = len(payload) >= 100 and first is not None and first != i
        result.append((i, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(result, key=str)


def test_round_trip(spark, tmp_path):
    rows, table = pages(spark)
    folder = f"file://{tmp_path}/archive"
    index = warc.write(table, folder, frame=4096, bundle=50_000)
    found = warc.read(index, folder).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=str) == expected(rows)
    stored = {r.page_id: bytes(r.payload) for r in found if r.payload is not None}
    assert all(stored[i] == (h or "").encode() for i, _, h in rows if i is not None and i in stored)
    few = warc.read(index.filter("page_id in (7, 502)"), folder, with_payload=False).collect()
    assert {(r.page_id, r.payload_bytes, r.payload) for r in few} == {(7, 7 * len("<p>page 7</p>"), None), (502, 2_000_000, None)}


def test_bundles_are_plain_zstandard_and_complete(spark, tmp_path):
    rows, table = pages(spark)
    index = warc.write(table, str(tmp_path / "a"), frame=4096, bundle=50_000)
    names = {r.bundle for r in index.select("bundle").distinct().collect()}
    assert names == set(os.listdir(tmp_path / "a")) and len(names) > 1
    total = 0
    for name in names:
        with open(tmp_path / "a" / name, "rb") as file:
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(file.read()), read_across_frames=True).read()
        total += raw.count(b"WARC/1.1\r\n")
    assert total == len(rows) == index.count()


def test_empty_table(spark, tmp_path):
    _, table = pages(spark)
    index = warc.write(table.limit(0), str(tmp_path / "none"))
    assert index.collect() == [] and warc.read(index, str(tmp_path / "none")).collect() == []
