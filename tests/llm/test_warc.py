"""WARC round trips."""

import base64
import gzip
import hashlib
import os

from statement_lake.llm import queries, warc

ROWS = [
    (5, "http://a/5", "<p>same</p>"), (3, "http://a/3 x\r\nX-Bad: 1", "<p>same</p>"), (9, None, "<p>same</p>"),
    (7, "http://a/7", None), (8, "http://a/8", ""), (1, "http://a/1", "é" * 100_000), (2, "http://a/2", "x\r\n\r\ny"),
    (None, "http://a/n", "<p>same</p>"), (None, "http://a/m", "alone"), (4, "http://a/4", "twice"), (4, "http://a/4", "twice"),
]


def frame(spark, rows):
    rows = [(*r, "z", 1) for r in rows]
    return spark.createDataFrame(rows, "page_id long, url string, html string, sum string, kind int")


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows):
    out, seen = [], set()
    for page, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        text = html or ""
        first = min((p for p, _, h in rows if (h or "") == text and p is not None), default=None)
        revisit = text in seen
        seen.add(text)
        size = len(text.encode())
        out.append((page, size, sha(text), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def test_round_trip(spark, tmp_path):
    manifest = warc.write_archives(frame(spark, ROWS), str(tmp_path / "w"), roll_bytes=300)
    found = warc.read_archives(manifest, str(tmp_path / "w"), payloads=True).collect()
    rows = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(rows, key=repr) == expected(ROWS)
    held = {r.payload_digest: r.payload.decode() for r in found if r.record_type == "response"}
    assert held == {sha(h): h or "" for _, _, h in ROWS}
    files = [f for f in os.listdir(tmp_path / "w") if f.endswith(".warc.gz")]
    assert len(files) > 3 and set(files) == {r.file for r in manifest.collect()}
    assert not os.listdir(tmp_path / "w" / "_temporary")


def test_equal_input_gives_equal_archives(spark, tmp_path):
    rows = [(i, f"http://a/{i}", f"page {i % 40} " * 50) for i in range(300)]
    sums = []
    for name in ("one", "two"):
        manifest = warc.write_archives(
            frame(spark, rows).repartition(5), str(tmp_path / name), shard_bytes=20_000, roll_bytes=4_000
        )
        sums.append(sorted((r.file, r.sha1) for r in manifest.collect()))
        found = warc.read_archives(manifest, str(tmp_path / name)).drop("url").collect()
        assert sorted(map(tuple, found), key=repr) == expected(rows)
    assert sums[0] == sums[1] and len(sums[0]) > 5


def test_short_payloads_may_be_kept_apart(spark, tmp_path):
    manifest = warc.write_archives(frame(spark, ROWS), str(tmp_path / "w"), least_bytes=6)
    found = warc.read_archives(manifest, str(tmp_path / "w")).collect()
    assert {r.record_type for r in found if r.payload_bytes < 6} == {"response"}
    assert sum(r.record_type == "revisit" for r in found) == 3


def test_damage_is_noticed(spark, tmp_path):
    manifest = warc.write_archives(frame(spark, ROWS), str(tmp_path / "w"))
    file = tmp_path / "w" / manifest.first().file
    data = gzip.decompress(file.read_bytes()).replace(b"alone", b"alonE")
    file.write_bytes(gzip.compress(data))
    try:
        warc.read_archives(manifest, str(tmp_path / "w")).collect()
    except Exception as error:
        assert "digest differs" in str(error)
    else:
        raise AssertionError("damage went unnoticed")


def test_no_rows(spark, tmp_path):
    manifest = warc.write_archives(frame(spark, []), str(tmp_path / "w"))
    assert warc.read_archives(manifest, str(tmp_path / "w")).count() == 0


def test_query(spark):
    pages = [tuple(r) for r in queries.table(spark, "/root/testdata/sf0.01", "pages").collect()]
    found = queries.op3_warc(spark, "/root/testdata/sf0.01")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in found.select(columns).collect()), key=repr) == expected(pages)
