import random

import pytest
from pyspark.sql import functions as F

from tricycle.llm.warc import FIXED, canonical_url, captures, header_text, resolved_revisits

SCHEMA = "record_id long, type string, url string, ts long, headers map<string,string>"


@pytest.mark.parametrize(
    "url, expected",
    [
        ("http://WWW.Example.org:80/a/b/?utm_source=x&b=2&a=1#top", "example.org/a/b?a=1&b=2"),
        ("https://user@example.org:443", "example.org"),
        ("https://blog.example.org/A?ref=x", "blog.example.org/A"),
        ("example.org/x?refer=1", "example.org/x?refer=1"),
        ("", ""),
        (None, None),
    ],
)
def test_canonical_url(spark, url, expected):
    assert spark.createDataFrame([(url,)], "url string").select(canonical_url("url").alias("c")).first().c == expected


def expected_rows(records):
    """Brute force over all earlier responses."""
    lowered = [(i, t, u, ts, {k.lower(): v for k, v in (h or {}).items()}) for i, t, u, ts, h in records]
    lowered = [r for r in lowered if r[0] is not None and r[2] is not None and r[3] is not None]
    out = []
    for i, kind, url, ts, headers in lowered:
        if kind != "revisit":
            continue
        before = [(r[3], r[0], r[4]) for r in lowered if r[1] == "response" and r[2] == url and (r[3], r[0]) < (ts, i)]
        if not before:
            out.append((i, None, "missing", headers))
            continue
        _, original, old = max(before, key=lambda r: r[:2])
        outcome = "unchecked"
        for name in ("etag", "last-modified"):
            a, b = headers.get(name), old.get(name)
            if a is not None and b is not None:
                outcome = "resolved" if a.removeprefix("W/") == b.removeprefix("W/") else "changed"
                break
        merged = old | {k: v for k, v in headers.items() if k not in FIXED}
        out.append((i, original, outcome, headers if outcome == "changed" else merged))
    return sorted(out, key=str)


def test_equals_brute_force_with_a_hot_url(spark):
    rng = random.Random(1)
    records = []
    for k in range(900):
        url = "hot.org/x" if rng.random() < 0.5 else f"site{rng.randrange(60)}.org/p"
        headers = {"ETag": rng.choice(["1", "2", "W/1"])} if rng.random() < 0.6 else {}
        headers |= {"Last-Modified": rng.choice("ab")} if rng.random() < 0.6 else {}
        headers |= {"Content-Length": str(k), "X-Own": str(k)} if rng.random() < 0.5 else {"Date": str(k)}
        records.append((k, "response" if rng.random() < 0.1 else "revisit", url, rng.randrange(200), headers))
    table = spark.createDataFrame(records, SCHEMA)
    found = sorted(((r.record_id, r.original_id, r.outcome, r.headers) for r in resolved_revisits(table).collect()), key=str)
    assert [(a, b, c, sorted(d.items())) for a, b, c, d in found] == [
        (a, b, c, sorted(d.items())) for a, b, c, d in expected_rows(records)
    ]


def test_edges(spark):
    records = [
        (1, "response", "a.org", 5, {"ETag": "1", "etag": "2"}),
        (2, "revisit", "a.org", 5, {"ETAG": "2"}),
        (2, "revisit", "a.org", 5, {"ETAG": "2"}),
        (3, "revisit", "a.org", 4, None),
        (4, "revisit", None, 5, None),
        (5, "revisit", "a.org", None, None),
        (None, "revisit", "a.org", 9, None),
        (6, None, "a.org", 9, None),
        (7, "request", "a.org", 9, None),
        (8, "revisit", "a.org", 9, None),
    ]
    table = spark.createDataFrame(records, SCHEMA).withColumns({"part": F.lit(1), "original": F.lit(1), "full": F.lit(1)})
    found = sorted((r.record_id, r.original_id, r.outcome) for r in resolved_revisits(table).select("record_id", F.coalesce("original_id", F.lit(-1)).alias("original_id"), "outcome").collect())
    assert found == [(2, 1, "resolved"), (2, 1, "resolved"), (3, -1, "missing"), (8, 1, "unchecked")]
    assert resolved_revisits(spark.createDataFrame([], SCHEMA)).collect() == []


def test_captures_of_pages(spark):
    pages = spark.createDataFrame([(1, "a.org", "<p>"), (2, None, None), (None, "b.org", "x")], "page_id long, url string, html string")
    log = captures(pages).collect()
    assert sorted(r.record_id for r in log) == list(range(4, 12))
    assert log == captures(pages).collect()
    texts = resolved_revisits(captures(pages)).select(header_text("headers").alias("t")).collect()
    assert texts and all(": " in r.t for r in texts)
