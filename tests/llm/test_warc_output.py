import base64
import gzip
import hashlib
import os

import pytest
from pyspark.errors import PySparkException

from millrace.llm import warc_output as w

PAGES = "page_id bigint, url string, html string, shard string, kind string, payload string, winner string, key string"
PAGE_TEXTS = ["<p>a</p>", "", None, "x" * 300_000, "naïve 日本 🙂", "<p>a</p>", "line\r\n\r\nline\r\n", "", "<p>a</p>"]


def pages(spark, rows):
    return spark.createDataFrame([(i, url, html, "s", "k", "p", "w", "y") for i, url, html in rows], PAGES)


def awkward():
    rows = [(10 + i, f"http://h/{i}", text) for i, text in enumerate(PAGE_TEXTS)]
    rows += [(None, None, "only here"), (None, "http://n/ü\r\nX: y", "<p>a</p>"), (3, "", "z"), (3, "", "z"), (3, "other", "z"),
             (-5, "http://neg", "z" * 10)]
    return rows + [(1000 + i, f"http://hot/{i}", "hot") for i in range(40)]


def want(rows):
    best = {}
    for page, _, html in rows:
        best.setdefault(html or "", []).append(page)
    out = []
    for html, ids in best.items():
        data = html.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        ids.sort(key=lambda p: (p is not None, p or 0))
        out += [(p, len(data), digest, "revisit", ids[-1]) for p in ids[:-1]] + [(ids[-1], len(data), digest, "response", None)]
    return sorted(out, key=repr)


def read(spark, path):
    return sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in w.read_archives(spark, path).collect()], key=repr)


def contents(path):
    return {name: open(f"{path}/{name}", "rb").read() for name in os.listdir(path) if name.endswith(".gz")}


@pytest.mark.parametrize("limits", [(1 << 25, 1 << 26), (2000, 300)])
def test_round_trip(spark, tmp_path, limits):
    rows = awkward()
    w.write_archives(pages(spark, rows).repartition(3), f"{tmp_path}/a", *limits)
    assert read(spark, f"{tmp_path}/a") == want(rows)
    got = {r.page_id: (r.url, r.payload) for r in w.read_archives(spark, f"{tmp_path}/a").collect()
           if r.record_type == "response" and r.page_id is not None}
    for page, url, html in rows:
        if page in got and page > 3:
            assert got[page] == (url, (html or "").encode())
    assert not os.path.exists(f"{tmp_path}/a/_temporary")
    if limits[1] == 300:
        assert len(contents(f"{tmp_path}/a")) > 5


def test_files_depend_on_the_pages_only(spark, tmp_path):
    rows = awkward() + [(5000 + i, f"u{i}", f"text {i} " * (i % 50)) for i in range(2000)]
    w.write_archives(pages(spark, rows).repartition(7), f"{tmp_path}/a", 20_000, 3000)
    w.write_archives(pages(spark, rows[::-1]).coalesce(1), f"{tmp_path}/b", 20_000, 3000)
    first, second = contents(f"{tmp_path}/a"), contents(f"{tmp_path}/b")
    assert first == second and len(first) > 10
    listed = {r.name: r for r in w.manifest(spark, f"{tmp_path}/a").collect()}
    assert set(listed) == set(first)
    for name, data in first.items():
        assert (listed[name].bytes, listed[name].sha1) == (len(data), hashlib.sha1(data).hexdigest())
        assert len(data) < 3000 + 2000
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
    bounds = sorted((r.first_page, r.last_page) for r in listed.values() if r.first_page is not None)
    assert all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:]))


def test_what_is_not_in_the_manifest_is_not_read(spark, tmp_path):
    rows = awkward()[:4]
    w.write_archives(pages(spark, rows), f"{tmp_path}/a")
    for stray in ("pages-00000-00009.warc.gz", "pages-00007-00000.warc.gz.attempt"):
        (tmp_path / "a" / stray).write_bytes(b"left by a lost executor")
    assert read(spark, f"{tmp_path}/a") == want(rows)


def test_damage_is_found(spark, tmp_path):
    w.write_archives(pages(spark, awkward()), f"{tmp_path}/a")
    name, data = next(iter(contents(f"{tmp_path}/a").items()))
    plain = gzip.decompress(data)
    for bad in (gzip.compress(plain[:plain.index(b"WARC/1.1", 10)]) + gzip.compress(
            plain[plain.index(b"WARC/1.1", 10):].split(b"WARC/1.1", 2)[1].join([b"WARC/1.1", b""]).replace(b"200 OK", b"200 KO")),
            data[:len(data) - 30]):
        (tmp_path / "a" / name).write_bytes(bad)
        with pytest.raises(PySparkException):
            w.read_archives(spark, f"{tmp_path}/a").collect()


def test_no_pages(spark, tmp_path):
    w.write_archives(pages(spark, []), f"{tmp_path}/a")
    assert w.read_archives(spark, f"{tmp_path}/a").collect() == []
