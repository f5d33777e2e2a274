import gzip
import hashlib
import random

from sitewise.llm import warc as V

SCHEMA = "page_id long, url string, html string"


def pages(seed=3):
    r = random.Random(seed)
    bodies = [f"<p>{i}</p>" * r.choice([1, 10, 150, 400]) + "é" for i in range(12)]
    rows = [(i, f"http://{r.choice(['a.example.com', 'b.example.org', 'User@WWW.x.net:80'])}/{r.randrange(8)}?q={i % 3}#f", r.choice(bodies)) for i in range(300)]
    rows += [(5, rows[5][1], rows[5][2]), (900, None, None), (901, "", ""), (902, "http://a\r\nb/ x", "x" * 1000), (903, "mailto:x", "x" * 999), (904, "http://z/", "x" * 1000), (905, "http://z/", "x" * 999)]
    rows += [(None, "http://n/", "x" * 1000), (906, "http://long/" + "p" * 5000, "y" * 300_000)]
    return rows


def expected(rows):
    body = lambda h: (h or "").encode()
    top = {}
    for i, _, h in rows:
        if len(body(h)) >= 1000 and i is not None:
            top[body(h)] = max(top.get(body(h), i), i)
    out = []
    for i, _, h in rows:
        b = body(h)
        holder = top.get(b)
        revisit = holder is not None and holder != i
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", holder if revisit else None))
    return sorted(out, key=repr)


def test_round_trip(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(V, "BLOCK_LINES", 4)
    rows = pages()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as key", "1 as size", "2 as digest")
    archive = V.write_archive(df, path="file://" + str(tmp_path / "w"))
    got = V.lookup(spark, archive, df, payload=True).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == expected(rows)
    texts = {i: (h or "").encode() for i, _, h in rows}
    assert all(bytes(r.payload) == texts[r.page_id] for r in got if r.record_type == "response")
    # the files are archives by themselves: gzip members, each one record
    records = 0
    for path in (tmp_path / "w").glob("*.warc.gz"):
        records += gzip.decompress(path.read_bytes()).count(b"WARC/1.1\r\nWARC-Type: re")
    assert records == len(rows) == archive.manifest.selectExpr("sum(records) as n").first().n


def test_lookup_finds_only_what_is_asked(spark):
    archive = V.write_archive(spark.createDataFrame(pages(), SCHEMA))
    some = spark.createDataFrame([(904, "http://z/"), (904, "http://z/"), (905, "http://nowhere/"), (-1, "http://z/")], "page_id long, url string")
    assert [(r.page_id, r.url) for r in V.lookup(spark, archive, some).collect()] == [(904, "http://z/")]


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert V.lookup(spark, V.write_archive(none), none).collect() == []


def test_keys(spark):
    urls = ["https://www.A.example.com:8080/b/C?x=1#f", "//h.org", "http://h.org?q", None, "a b", "http://u:p@h.org/%20é"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(V.surt(V.F.col("u"))).collect()]
    assert got == ["com,example,a,www)/b/C?x=1", "org,h)/", "org,h)/?q", ")/", ")/a%20b", "org,h)/%20é"]
