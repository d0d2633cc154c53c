"""WARC: an exact round trip, revisits against a plain recomputation."""

import gzip
import hashlib
import io
import os

from almanac.llm import warc


def want(rows):
    first = {}
    for i, _, h in rows:
        p = (h or "").encode()
        if len(p) >= 100 and i is not None:
            first[p] = min(first.get(p, i), i)
    out, used = [], set()
    for i, _, h in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        p = (h or "").encode()
        digest, again = hashlib.sha256(p).hexdigest(), (i, p) in used
        used.add((i, p))
        response = i is None or p not in first or (first[p] == i and not again)
        out.append((i, len(p), digest, "response" if response else "revisit", None if response else first[p]))
    return sorted(out, key=str)


def run(spark, rows, folder, **kw):
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    manifest = warc.write_archives(pages.repartition(4), str(folder), **kw)
    back = warc.read_archives(spark, str(folder)).collect()
    return manifest.collect(), back


def test_round_trip(spark, tmp_path):
    long = "é\r\n\r\n" * 60
    rows = [(i, f"http://x/{i}\r\nWARC-Type: evil y", f"<p>{i}</p>\r\n\r\nWARC/1.1\r\n" * (i % 9)) for i in range(60)]
    rows += [(100 + i, None, long) for i in range(30)] + [(50, "u", long), (50, "u", long), (7, "v", "short"), (8, "w", "short")]
    rows += [(None, "n", long), (None, None, None), (200, "", ""), (201, "big", "b" * 300_000)]
    manifest, back = run(spark, rows, tmp_path / "a", roll=2000)
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back), key=str)
    assert got == want(rows)
    texts = {(i, (h or "").encode()) for i, _, h in rows}
    assert all((r.page_id, r.payload) in texts for r in back if r.record_type == "response")
    # files roll, records are in order, nothing temporary is left, the manifest names all files
    assert len(manifest) > 5 and sum(r.records for r in manifest) == len(rows)
    names = {f for f in os.listdir(tmp_path / "a") if f.endswith(".warc.gz")}
    assert names == {r.final for r in manifest} and "_temporary" not in os.listdir(tmp_path / "a")
    for r in manifest:
        data = (tmp_path / "a" / r.final).read_bytes()
        assert len(data) == r.bytes and hashlib.sha256(data).hexdigest() == r.sha256
    order = []
    for name in sorted(names):
        with gzip.open(tmp_path / "a" / name) as z:
            order += [h["X-Page-Id"] for h, _ in warc.parse(io.BufferedReader(z))]
    order = [-1 if x == "null" else int(x) for x in order]
    assert order == sorted(order)


def test_same_bytes_each_time(spark, tmp_path):
    rows = [(i, f"http://x/{i}", f"text {i % 7} " * 40) for i in range(80)]
    a, _ = run(spark, rows, tmp_path / "a", roll=3000)
    b, _ = run(spark, rows[::-1], tmp_path / "b", roll=3000)
    files = lambda m: sorted((r.final, r.sha256) for r in m)
    assert files(a) == files(b)


def test_empty(spark, tmp_path):
    manifest, back = run(spark, [], tmp_path / "e")
    assert manifest == [] and back == []


def test_query(spark, sf_dir):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    got = warc.op4_warc_round_trip(spark, sf_dir).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == want(pages)
