import gzip
import hashlib
from pathlib import Path

from passante.llm import urlfilter, warc

SCHEMA = "page_id bigint, url string, html string, host string, digest string, kind int, rule string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "h", "d", 3, "r") for r in rows], SCHEMA)


BIG = "é" * 600  # 1200 bytes
ROWS = [(1, "http://A.example.com/x?q#f", BIG), (2, "https://b.example.com/", BIG), (9, "http://www.example.com/en/", BIG), (3, None, None), (4, "no scheme", ""),
        (5, "http://x.net/a b\n", "small"), (6, "http://x.net/", "small"), (7, "http://x.net/", "z" * 200_000), (7, "http://x.net/", "z" * 200_000),
        (None, "http://y.org", BIG), (None, None, "q" * 2000), (None, None, "q" * 2000), (8, "http://y.org/" + "p" * 5000, "\x00\r\n\r\n<html>")]


def test_round_trip_and_revisits(spark, tmp_path):
    table = pages(spark, ROWS)
    archive = warc.Archive.write(table, str(tmp_path / "a"))
    got = archive.lookup(table).collect()
    assert len(got) == len(ROWS)
    key = lambda r: tuple(str(x) for x in r)
    want = []
    for page_id, url, html in ROWS:
        payload = (html or "").encode()
        same = [i for i, _, h in ROWS if (h or "") == (html or "") and i is not None]
        first = max(same) if len(payload) >= 1000 and same else None
        revisit = first is not None and first != page_id
        want.append((page_id, url, None if revisit else html or "", len(payload), hashlib.sha1(payload).hexdigest(),
                     "revisit" if revisit else "response", first if revisit else None))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_archives_are_plain_warc_files(spark, tmp_path):
    warc.Archive.write(pages(spark, ROWS), str(tmp_path / "a"))
    data = b"".join(gzip.decompress(p.read_bytes()) for p in Path(tmp_path / "a/files").glob("*.warc.gz"))
    assert data.count(b"WARC/1.1\r\nWARC-Type: response") == len(ROWS) - 3
    assert data.count(b"WARC/1.1\r\nWARC-Type: revisit") == 3
    assert b"WARC-Target-URI: http://x.net/a%20b%0A\r\n" in data


def test_lookup_finds_single_pages_across_blocks_and_shards(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 4)
    rows = [(i, f"http://h{i % 5}.org/{i % 3}", f"page {i}") for i in range(200)] + [(500 + i, "http://same.org/", "t") for i in range(40)]
    table = pages(spark, rows).repartition(6)
    archive = warc.Archive.write(table, str(tmp_path / "a"))
    asked = table.where("page_id % 10 = 3").union(pages(spark, [(999, "http://h1.org/1", ""), (3, "http://other.org", "")]))
    assert sorted((r.page_id, r.payload) for r in archive.lookup(asked).collect()) == sorted((i, h) for i, _, h in rows if i % 10 == 3)


def test_empty_archive(spark, tmp_path):
    none = pages(spark, [])
    archive = warc.Archive.write(none, str(tmp_path / "a"))
    assert archive.lookup(none).count() == 0 and archive.lookup(pages(spark, ROWS)).count() == 0


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"),
         ("example.org", "/pa", "block"), ("EXAMPLE.org", "/path/x", "allow"), ("", "/", "block"), (None, "/", "block"), ("tie.net", "/", "allow"), ("tie.net", "/", "block"), ("bare.net", "", "block")]


def plain(url, rules):
    """host, path, rule and verdict by trying every rule."""
    rest = (url or "").partition("://")[2] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("#")[0].split("?")[0]
    fits = [(len(h) + len(p), v, h.lower() + p) for h, p, v in rules if h and p is not None and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
    best = max(fits, default=(0, urlfilter.DEFAULT_VERDICT, None))
    return host, path, best[2], best[1]


def test_verdicts_equal_trying_every_rule(spark):
    urls = ["http://a.com/", "http://a.com", "http://a.com?x", "https://WWW.Example.COM/en/1?y", "http://m.example.com/en/", "http://notexample.com/en/", "http://x.net/es/1#z",
            "http://net/fr/", "http://ne.t/fr/", "ftp://q.example.org/path/x/y", "http://example.org/pat", "//no.scheme/", "plain", "", None, "http://", "http:///x", "x://É.NET/es/é",
            "http://tie.net/a", "http://bare.net", "http://a.bare.net/x", "http://a..com//", "a://b://c.com/", "http://h/" + "y" * 4000, "http://u@x.com:80/", "http://x.com/\n/es/"]
    rows = [(i, u, None) for i, u in enumerate(urls)] + [(None, "http://x.net/es/", None), (1, urls[1], None)]
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = urlfilter.judge(pages(spark, rows), rules).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(((i, *plain(u, RULES)) for i, u, _ in rows), key=key)


def test_without_rules_or_pages(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert [r.verdict for r in urlfilter.judge(pages(spark, ROWS), none).collect()] == ["allow"] * len(ROWS)
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert urlfilter.judge(pages(spark, []), rules).count() == 0
