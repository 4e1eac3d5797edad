"""Archives written and read back, against the pages themselves."""

import gzip
import hashlib

import pytest

from shopgrain.llm import warc
from shopgrain.llm.warc import (
    capture_digests,
    decompressed,
    read_archives,
    records,
    transactions,
    write_archives,
)
from shopgrain.plans.saving import new_folder

BIG = "<p>" + "é" * 600 + "</p>"
HOSTILE = "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 40
ROWS = [
    (1, "http://a/1", BIG, 7),
    (5, "http://a/2", BIG, 7),
    (3, "http://a/3\r\nX: y", BIG, 7),
    (5, "http://a/2", BIG, 7),
    (None, "http://a/4", BIG, 7),
    (6, None, "short", 7),
    (7, "u", "short", 7),
    (8, "u", None, 7),
    (9, "u", "", 7),
    (10, "u", HOSTILE, 7),
    (11, "u", "x" * 3_000_000, 7),
    (None, "u", "alone" * 300, 7),
]
SCHEMA = "page_id long, url string, html string, value int"


def expected(rows):
    out = []
    for page, _, html, _ in rows:
        payload = (html or "").encode()
        same = [r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None]
        holder = max(same, default=None)
        revisit = len(payload) >= 1000 and holder is not None and page != holder
        digest = hashlib.sha1(payload).hexdigest()
        kind = "revisit" if revisit else "response"
        out.append((page, len(payload), digest, kind, holder if revisit else None))
    return sorted(out, key=repr)


def test_round_trip_and_edge_rows(spark):
    """Null and empty payloads, a null id, repeated rows, records inside a payload."""
    folder = new_folder(spark)
    write_archives(spark.createDataFrame(ROWS, SCHEMA), folder, "page_id", "url", "html")
    read = read_archives(spark, folder)
    assert read.count() == 3 * len(ROWS)
    got = capture_digests(transactions(read)).collect()
    assert sorted(map(tuple, got), key=repr) == expected(ROWS)
    payloads = {
        r.payload_digest: r.payload.decode() for r in read.where("type = 'response'").collect()
    }
    assert set(payloads.values()) == {r[2] or "" for r in ROWS}
    nested = transactions(read).collect()
    assert all(r.request.target_uri == r.response.target_uri for r in nested)
    ids = [r.record_id for r in read.select("record_id").collect()]
    assert len(ids) == len(set(ids))


def test_no_rows(spark):
    folder = new_folder(spark)
    write_archives(spark.createDataFrame([], SCHEMA), folder, "page_id", "url", "html")
    assert capture_digests(transactions(read_archives(spark, folder))).count() == 0


def test_assembly_of_incomplete_transactions(spark):
    rows = [
        ("r1", "response", None), ("q2", "request", "r1"), ("q1", "request", "r1"),
        ("r2", "response", None), ("q9", "request", "gone"), ("m1", "metadata", None),
    ]
    df = spark.createDataFrame(rows, "record_id string, type string, concurrent_to string")
    df = df.selectExpr(
        "*", "cast(null as string) target_uri", "cast(null as string) date",
        "cast(null as map<string,string>) fields",
    )
    got = {r.capture_id: r.request and r.request.record_id for r in transactions(df).collect()}
    assert got == {"r1": "q1", "r2": None}


def one(text):
    return f"WARC/1.1\r\nWARC-Type: x\r\nContent-Length: {len(text)}\r\n\r\n".encode() + text + b"\r\n\r\n"


@pytest.mark.parametrize("step", [1, 7, 1000])
def test_records_from_chunks_of_any_size(step):
    blocks = [b"", b"abc", b"\r\n\r\n" * 5, b"WARC/1.1\r\n\r\n"]
    data = b"".join(map(one, blocks))
    chunks = (data[i : i + step] for i in range(0, len(data), step))
    assert [block for _, block in records(chunks)] == blocks


def test_gzip_members():
    import pyarrow as pa

    data = b"".join(gzip.compress(one(b"x" * n)) for n in (0, 10, 3_000_000))
    assert [len(b) for _, b in records(decompressed(pa.py_buffer(data)))] == [0, 10, 3_000_000]
    assert [len(b) for _, b in records(decompressed(pa.py_buffer(one(b"xyz"))))] == [3]
    with pytest.raises(ValueError, match="inside a record"):
        list(records(iter([one(b"abcdef")[:-6]])))


def test_query_equals_its_sql(spark):
    import duckdb

    from shopgrain.llm.queries import QUERIES, SQL

    folder = "/root/testdata/sf0.001"
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    expected = connection.execute(SQL["op7_warc"])
    names = [d[0] for d in expected.description]
    got = QUERIES["op7_warc"](spark, folder).select(names)
    assert sorted(map(tuple, got.collect())) == sorted(expected.fetchall())


def test_files_are_bounded_in_bytes(spark, monkeypatch, tmp_path):
    """Captures of a size share files, the fewer the larger they are."""
    monkeypatch.setattr(warc, "SIZES", ((100, 10), (10_000, 3), (None, 1)))
    sizes = [50] * 25 + [5_000] * 7 + [200_000] * 2 + [100, 10_000]
    rows = [(i, "u", chr(97 + i % 26) * n + str(i), i) for i, n in enumerate(sizes)]
    rows += [(900, "u", None, 0)]
    folder = new_folder(spark)
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    write_archives(df, folder, "page_id", "url", "html")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    held = []
    for r in files.collect():
        found = [b for h, b in records(decompressed(memoryview(r.content))) if h["warc-type"] == "response"]
        held.append((len(found), sum(map(len, found))))
    assert sum(n for n, _ in held) == len(rows)
    assert all(n == 1 or size <= max(10 * 250, 3 * 10_250) for n, size in held)
    found = capture_digests(transactions(read_archives(spark, folder)))
    assert sorted(map(tuple, found.collect()), key=repr) == expected(rows)
