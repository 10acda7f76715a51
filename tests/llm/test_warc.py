import hashlib
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from vigil.llm import warc as W
from vigil.llm.queries import QUERIES

KIND = "page_id long, url string, html string"


def plain(rows):
    largest, often = {}, {}
    for i, _, html in rows:
        b = (html or "").encode()
        often[b] = often.get(b, 0) + 1
        if len(b) >= 1000 and i is not None:
            largest[b] = max(largest.get(b, i), i)
    out = []
    for i, _, html in rows:
        b = (html or "").encode()
        again = often[b] > 1 and b in largest and largest[b] != i
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", largest[b] if again else None))
    return sorted(out, key=repr)


def test_round_trip(frame):
    tricky = "WARC/1.1\r\n\r\n\r\n\r\nContent-Length: 5\r\n\r\n<p>é漢\x00</p>" * 30
    rows = [(1, "http://a/", "x" * 999), (2, "http://b/", "x" * 999), (3, "u", "y" * 1000), (9, "u", "y" * 1000), (5, None, "y" * 1000),
            (6, "http://c/ d\r\nX: 1", tricky), (7, "e", tricky), (8, "f", None), (None, "g", tricky), (None, "h", "z" * 2000),
            (None, "h", "z" * 2000), (10, "i", ""), (11, "j", "é" * 500), (12, "k", "é" * 500), (12, "k", "é" * 500), (13, "l", "é" * 499)]
    df = frame(rows, KIND).withColumn("digest", F.lit("clash")).withColumn("size", F.lit(1))
    got = sorted((tuple(r) for r in W.round_trip(df).collect()), key=repr)
    assert got == plain(rows)


def test_files_are_plain_records(frame, tmp_path):
    path = str(tmp_path / "w")
    W.write_archives(frame([(1, "http://a/", "p" * 1200), (2, "http://b/", "p" * 1200)], KIND), path, compression="none")
    data = b"".join(open(os.path.join(path, f), "rb").read() for f in sorted(os.listdir(path)) if f.startswith("part"))
    assert data.count(b"WARC/1.1\r\n") == 2 and data.endswith(b"\r\n\r\n")
    records = {r[1]: r for r in W.parse_file(data)}
    assert records["revisit"][5] == records["response"][0] and records["response"][4] == 1200
    assert b"WARC-Profile: " + W.PROFILE.encode() in data and data.count(b"p" * 1200) == 1


def test_damage_is_found():
    good = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <x>\r\nWARC-Payload-Digest: sha1:%s\r\nContent-Length: 27\r\n\r\n"
    body = b"H\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    good = good % hashlib.sha1(b"abc").hexdigest().encode()
    assert list(W.parse_file(good + body))[0][4] == 3
    with pytest.raises(ValueError):
        list(W.parse_file(good + body.replace(b"abc", b"abd")))
    with pytest.raises(ValueError):
        list(W.parse_file(b"XX" + good + body))


def test_empty_table(frame):
    assert W.round_trip(frame([], KIND)).collect() == []


def test_hot_payload(frame):
    rows = [(k, "u", "hot" * 400) for k in range(300)] + [(1000 + k, "u", f"{k}" * 1200) for k in range(5)]
    got = sorted((tuple(r) for r in W.round_trip(frame(rows, KIND)).collect()), key=repr)
    assert got == plain(rows)


def test_query(spark, small):
    rows = duckdb.sql(f"SELECT page_id, url, html FROM '{small}/pages.parquet'").fetchall()
    assert sorted((tuple(r) for r in QUERIES["op8_warc"](spark, small).collect()), key=repr) == plain(rows)
