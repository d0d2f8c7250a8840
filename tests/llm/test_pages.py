"""WARC archives and URL filters."""

import hashlib
import random

import duckdb
import pytest

from creditmill.llm.queries import ORACLES
from creditmill.llm import components as components_module
from creditmill.llm import url_filter, warc
from creditmill.llm.components import components

PAGES = "page_id bigint, url string, html string, payload string, digest string, host int, rule int, n int"


@pytest.fixture(scope="module")
def pages(spark):
    def make(rows, parts=3):
        return spark.createDataFrame([(*r, "p", "d", 1, 2, 3) for r in rows], PAGES).repartition(parts)

    return make


def test_archive_round_trip(spark, pages, tmp_path):
    big, other = "<p>\u00e9</p>\r\n\r\nWARC/1.1\r\n" * 20, "z" * 100
    rows = [(4, "http://a/", big), (2, "http://b/\r\nx", big), (9, None, big), (None, "u", big), (1, "u", "small"), (3, "u", "small"),
            (5, "u", None), (6, "u", ""), (7, "u", other), (7, "u", other), (8, "u", "y" * 300_000)]
    path = str(tmp_path / "archive")
    warc.write_archive(pages(rows), path)
    got = warc.read_archive(spark, path).collect()
    assert len(got) == len(rows)
    stored = spark.read.parquet(f"{path}/payloads").collect()
    assert len(stored) == len({r[2] or "" for r in rows})  # each payload once
    want = sorted((r[0] or -1, (r[2] or "").encode()) for r in rows)
    assert sorted((r.page_id or -1, bytes(r.payload)) for r in got) == want
    for r in got:
        record, payload = bytes(r.record), bytes(r.payload)
        head, _, rest = record.partition(b"\r\n\r\n")
        fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and rest.endswith(b"\r\n\r\n")
        assert int(fields[b"Content-Length"]) == len(rest) - 4 == r.content_length
        assert fields[b"WARC-Payload-Digest"].decode() == "sha256:" + hashlib.sha256(payload).hexdigest()
        block = rest[:-4].split(b"\r\n\r\n", 1)[1]
        assert block == (payload if r.record_type == "response" else b"")
    kind = {}
    for r in got:
        kind.setdefault(r.page_id, []).append((r.record_type, r.refers_to))
    assert kind[2] == [("response", None)] and kind[4] == kind[9] == kind[None] == [("revisit", 2)]
    assert kind[1] == kind[3] == kind[5] == kind[6] == [("response", None)]
    assert sorted(kind[7], key=str) == [("response", None), ("revisit", 7)]


def test_damaged_payload_is_noticed(spark, pages, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archive(pages([(1, "u", "a" * 200), (2, "u", "b" * 200)]), path)
    spark.read.parquet(f"{path}/records").write.parquet(str(tmp_path / "bad/records"))
    spark.read.parquet(f"{path}/payloads").selectExpr("digest", "payload_bytes", "copies", "reverse(concat('x', payload)) payload") \
        .selectExpr("digest", "payload_bytes", "copies", "cast(payload AS binary) payload").write.parquet(str(tmp_path / "bad/payloads"))
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_archive(spark, str(tmp_path / "bad")).collect()


def test_hot_payload_is_sharded(pages, monkeypatch):
    monkeypatch.setattr(warc, "PER_SHARD", 50)
    rows = [(i, "u", "hot" * 100 if i % 3 else f"own {i}") for i in range(600)]
    got = warc.round_trip(pages(rows, 5)).collect()
    assert sorted((r.page_id, bytes(r.payload).decode()) for r in got) == sorted((r[0], r[2]) for r in rows)
    assert sum(r.record_type == "revisit" for r in got) == 399
    assert warc.round_trip(pages([])).collect() == []


CASES = [("http://X.Example.NET/en/a?b#c", "x.example.net", "/en/a", "example.net/en/", "allow"),
         ("http://x.example.net/fr/", "x.example.net", "/fr/", "net/", "block"), ("https://net/", "net", "/", "net/", "block"),
         ("https://net", "net", "", None, "allow"), ("https://inet/", "inet", "/", None, "allow"),
         ("ftp://a.org/fr/x", "a.org", "/fr/x", "org/fr/", "allow"), ("//a.net/", "", "", None, "allow"), (None, "", "", None, "allow"),
         ("a://b.example.com/de/?u=://c.net/", "b.example.com", "/de/", "example.com/de/", "block"),
         ("http://\u00c9X.net/#/", "\u00c9x.net", "/", "net/", "block"), ("", "", "", None, "allow")]


def test_rules(pages):
    got = url_filter.judge(pages([(i, c[0], None) for i, c in enumerate(CASES)])).collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got} == {i: c[1:] for i, c in enumerate(CASES)}
    assert url_filter.judge(pages([])).collect() == []


def canonical(href):
    return f'<html><head><LINK href="{href}" rel="canonical"></head>'


def test_blocks_reach_aliases(spark, pages):
    rows = [(1, "http://plain.com/a", canonical("https://bad.net/x?q=1&amp;r=2")),  # an alias of a blocked URL
            (2, "http://mirror.com/", '<meta http-equiv="refresh" content="0; url=http://plain.com/a">'),  # by two steps
            (3, "http://ok.org/fr/", canonical("http://bad.net/x")),  # its own rule allows
            (4, "http://free.com/", canonical("http://good.example.net/en/")), (5, "http://free.com/#top", "none"),
            (6, "http://free.com/z", canonical("http://bad.net/z")), (7, "http://free.com/y", canonical("/z")),
            (8, "http://t.com/d/p", canonical("q")), (9, "http://t.com/d/q", None), (10, "http://moved.com/", None),
            (11, "http://c.com/", canonical("http://good.example.net/en/")), (12, "http://c.com/", canonical("http://worse.net/"))]
    redirects = spark.createDataFrame([("http://moved.com/", "http://worse.net/"), ("x", None)], "from_url string, to_url string")
    got = {(r.page_id): r.verdict for r in url_filter.judge(pages(rows), redirects=redirects).collect()}
    assert {i for i, v in got.items() if v == "block"} == {1, 2, 6, 7}  # worse.net is cleared by the allowed alias of 11 and 12
    alone = {r.page_id: r.verdict for r in url_filter.judge(pages(rows[:10]), redirects=redirects).collect()}
    assert alone[10] == "block"


def test_all_links_of_a_page_count(spark, pages):
    rows = [(1, "http://two.com/", canonical("http://fine.org/a") + canonical("http://bad.net/x")),
            (2, "http://many.com/", "".join(f'<meta http-equiv=refresh content="1; url=/{i}">' for i in range(5)) + canonical("/b")),
            (3, "http://many.com/4", canonical("http://bad.net/")), (4, "http://many.com/b", None), (5, "http://many.com/c", None),
            (6, "http://fine.org/a", '<link rel="canonical">')]
    frame = pages(rows)
    got = {r.page_id: r.verdict for r in url_filter.judge(frame).collect()}
    assert {i for i, v in got.items() if v == "block"} == {1, 2, 3, 4, 6}
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    sql = con.execute(f"SELECT page_id, verdict FROM ({ORACLES['op7_url_filter']})").fetchall()
    assert dict(sql) == got


@pytest.mark.parametrize("broadcast", [0, 1_000_000])
def test_components(spark, monkeypatch, broadcast):
    monkeypatch.setattr(components_module, "BROADCAST_EDGES", broadcast)
    rng = random.Random(4)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    edges += [(1000, i) for i in range(1001, 1400)] + [(i, i + 1) for i in range(2000, 2060)] + [(7, 7), (3000, 3000)]
    parent = {}

    def find(x):
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
