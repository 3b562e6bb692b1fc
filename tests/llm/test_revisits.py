import datetime as dt

from govlake.llm import revisits
from pyspark.sql import functions as F

SCHEMA = "capture_id long, url string, time timestamp, status int, headers map<string,string>, payload_sha256 string, slice int, found string"
DAY = dt.datetime(2024, 1, 1)


def resolve(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    return {r.capture_id: r for r in revisits.resolve_revisits(df, slice_seconds=86400).collect()}


def capture(i, day, status, headers=None, url="http://a.com/x", sha=None):
    return (i, url, None if day is None else DAY + dt.timedelta(days=day), status, headers, sha or (f"s{i}" if status == 200 else None))


def test_latest_earlier_response(spark):
    out = resolve(spark, [
        capture(1, 0, 200, {"ETag": '"a"', "X": "1", "Cache-Control": "no"}),
        capture(2, 40, 200, {"ETag": '"b"'}),
        capture(3, 41, 304, {"etag": 'W/"b"', "Set-Cookie": "z", "cache-control": "yes"}),
        capture(4, 5, 304, {"ETAG": '"a"', "Date": "d"}, "https://WWW.a.com:443/x/?utm_source=q#f"),
        capture(5, 41, 304, {"etag": '"a"'}),
        capture(6, 90, 200, {}),
        capture(7, 40, 304, None),  # the same time as a smaller id
        capture(8, -1, 304, None),
        capture(9, 6, 404, None),
    ])
    assert {k: (r.verdict, r.resolved_id, r.candidate_id) for k, r in out.items()} == {
        3: ("etag", 2, 2), 4: ("etag", 1, 1), 5: ("mismatch", None, 2), 7: ("unverified", 2, 2), 8: ("unresolved", None, None)}
    assert out[4].headers == {"etag": '"a"', "x": "1", "cache-control": "no", "date": "d"} and out[4].payload_sha256 == "s1"
    assert out[3].headers == {"etag": 'W/"b"', "cache-control": "yes"}


def test_odd_rows(spark):
    out = resolve(spark, [
        capture(1, None, 200, {"last-modified": "m", "Last-Modified": "n"}),
        capture(2, 0, 304, {"Last-Modified": "m"}),
        capture(3, 0, 304, None, None), capture(4, None, 304, None, ""), capture(5, 0, 200, None, None),
        capture(6, 1, 304, {"etag": None}), capture(6, 1, 304, {"etag": None}),
        (None, "http://a.com/x", DAY, 304, {}, None),
    ])
    assert out[2].verdict == "last-modified" and out[3].verdict == out[4].verdict == "unresolved" and out[6].resolved_id == 1
    assert len(out) == 5 and resolve(spark, []) == {}


def test_hot_url_over_many_slices(spark):
    rows = [capture(i, i // 7, 200 if i % 13 == 0 else 304, None) for i in range(700)]
    out = resolve(spark, rows)
    assert all(r.resolved_id == i - i % 13 for i, r in out.items())


def test_canonical_urls(spark):
    urls = {
        "HTTP://www.A.com:80/p/?b=2&a=1&utm_x=3#z": "https://a.com/p?a=1&b=2", "https://m.a.com": "https://a.com", "http://a.com/?": "https://a.com",
        "http://a.com:8080/P?gclid=1": "https://a.com:8080/P", " https://a.com/p?x&fbclid ": "https://a.com/p?x",
    }
    df = spark.createDataFrame([(u,) for u in urls], "u string").select("u", revisits.canonical_url(F.col("u")))
    assert {r[0]: r[1] for r in df.collect()} == urls
