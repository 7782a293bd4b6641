import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tillroll.llm import warc

SCHEMA = "record_id long, url string, date timestamp, kind string, status int, headers map<string,string>, digest string, range string"
T = dt.datetime(2024, 1, 1)


def at(n):
    return T + dt.timedelta(minutes=n)


def run(spark, rows, parts=4):
    frame = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA).repartition(parts)
    return {r.record_id: r for r in warc.resolve_revisits(frame).collect()}


@pytest.mark.parametrize(
    ("url", "expected"),
    [
        ("HTTP://WWW.Example.com:80/a/?b=2&utm_source=x&a=1#frag", "example.com/a?a=1&b=2"), ("https://example.com", "example.com"),
        ("https://example.com/?ref=z", "example.com"), ("ftp://h/x?", "h/x"), (None, None), ("", None), ("no scheme", None), ("http:///x", None),
    ],
)
def test_canonical_urls(spark, url, expected):
    frame = spark.createDataFrame([(url,)], "url string")
    assert frame.select(warc.canonical_url(F.col("url"))).first()[0] == expected


FULL = {"ETag": 'W/"1"', "Last-Modified": "mon", "Content-Type": "text/html", "Content-Length": "9", "X": "old"}


def test_validators_and_headers(spark):
    fresh = {"etag": '"1"', "content-length": "0", "x": "new", "Age": "5", "Connection": "close"}
    rows = [
        (1, "http://a/x", at(0), "response", 200, FULL, None),
        (2, "https://www.A/x#y", at(5), "revisit", 304, fresh, None),
        (3, "http://a/x", at(6), "revisit", 304, {"etag": '"2"', "last-modified": "mon"}, None),
        (4, "http://a/x", at(7), "revisit", 304, {"Last-Modified": "mon"}, None),
        (5, "http://a/x", at(8), "revisit", 304, None, None),
        (6, "http://a/x", at(-1), "revisit", 304, fresh, None),
        (7, "http://a/x", at(9), "response", 404, {"etag": '"9"'}, None),
        (8, "http://a/x", at(10), "revisit", 304, {"last-modified": "tue"}, "sha1:a"),
        (9, None, at(10), "revisit", 304, fresh, None),
        (10, "http://a/x", None, "revisit", 304, fresh, None),
        (11, "http://a/x", at(20), "response", 200, {}, "sha1:a"),
        (12, "http://a/x", at(21), "revisit", 304, {}, "sha1:a"),
        (13, "http://a/x", at(21), "revisit", 304, {}, "sha1:b"),
        (14, "http://a/x", at(20), "revisit", 304, {}, None),
        (15, None, None, None, None, None, None),
    ]
    got = run(spark, rows)
    outcome = {k: (r.outcome, r.resolved_id) for k, r in got.items()}
    assert outcome == {
        2: ("resolved", 1), 3: ("changed", None), 4: ("resolved", 1), 5: ("unchecked", 1), 6: ("missing", None), 8: ("changed", None),
        9: ("missing", None), 10: ("missing", None), 12: ("resolved", 11), 13: ("changed", None), 14: ("unchecked", 11),
    }
    assert got[2].headers == {"etag": '"1"', "last-modified": "mon", "content-type": "text/html", "content-length": "9", "x": "new", "age": "5"}
    assert got[6].headers["x"] == "new" and got[5].headers["x"] == "old"


@pytest.mark.parametrize("parts", [1, 7])
def test_as_of_equals_a_scan_with_one_url_holding_most_captures(spark, parts):
    dice = random.Random(parts)
    rows = []
    for i in range(1500):
        url = "http://hot/" if dice.random() < 0.6 else f"http://h{dice.randrange(40)}/"
        full = dice.random() < 0.3
        rows.append((i, url, at(dice.randrange(300)), "response" if full else "revisit", 200 if full else 304, {"etag": str(dice.randrange(3))}, None))
    got = run(spark, rows, parts)
    for i, url, date, kind, _, headers, _ in rows:
        if kind == "revisit":
            earlier = [r for r in rows if r[1] == url and r[3] == "response" and (r[2], r[0]) < (date, i)]
            last = max(earlier, key=lambda r: (r[2], r[0]), default=None)
            expected = ("missing", None) if last is None else ("resolved", last[0]) if last[5] == headers else ("changed", None)
            assert (got[i].outcome, got[i].resolved_id) == expected


def test_repeated_rows_are_answered_each_and_names_fall_together(spark):
    rows = [(1, "http://a/", at(0), "response", 200, FULL, None)] * 2 + [(2, "http://a/", at(1), "revisit", 304, {"X": "a", "x": "b"}, None)] * 3
    frame = spark.createDataFrame([(*r, "") for r in rows], SCHEMA)
    found = warc.resolve_revisits(frame).collect()
    assert len(found) == 3 and all(r.resolved_id == 1 and r.headers["x"] in "ab" for r in found)


@pytest.mark.parametrize("rows", [[], [(1, "http://a/", at(0), "response", 200, None, None)]])
def test_tables_without_revisits(spark, rows):
    assert run(spark, rows) == {}
