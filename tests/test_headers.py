"""Header maps, HTTP split and record text, by hand-made bytes."""

import pytest
from pyspark.sql import functions as F

import warcloom as w
from warcloom.functions import headers as H
from warcloom.functions.identity import name_uuid

RESPONSE = "application/http; msgtype=response"


def one(spark, schema, value, column):
    return each(spark, schema, [value], column)[0]


def each(spark, schema, values, column):
    """The column for each value, in order, by one query."""
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, {schema}")
    return [r["y"] for r in rows.select("i", column.alias("y")).orderBy("i").collect()]


WARC_HEADERS_CASES = [
    (b"A: b:c", {"A": "b:c"}),
    (b"A:\tb \r", {"A": "b"}),
    (b" \x01A\x1f : b\x0b", {"A": "b"}),
    (b": x", {}),
    (b"Foo", {"Foo": ""}),
    (b"Foo\r\nBar:\r", {"Bar": "", "Foo": ""}),
    (b"Foo: 1\r\nb: 2\r\nFOO: 3", {"b": "2", "Foo": "3"}),
    (b"a: 1\nA: 2\na: 3\nB: 4", {"a": "3", "B": "4"}),
    ("Ä: 1\nä: 2".encode(), {"Ä": "2"}),
    (b"A: \xff\xe2\x82", {"A": "\ufffd\ufffd"}),
    ("A: é€😀".encode(), {"A": "é€😀"}),
    (b"", {}),
]


def test_warc_headers(spark):
    lines, expected = zip(*WARC_HEADERS_CASES)
    got = each(spark, "x binary", lines, H.warc_headers(F.col("x")))
    assert [list(m.items()) for m in got] == [list(m.items()) for m in expected]


HTTP_HEADERS_CASES = [
    (b"HTTP/1.1 200 OK\r\n", {"__HTTP_STATUS__": "HTTP/1.1 200 OK"}),
    (b"HTTP/2 200\n", {"HTTP/2 200": ""}),
    (b"HTTP/1.1 200 OK: x\n", {"HTTP/1.1 200 OK": "x"}),
    (b"Set-Cookie: a\r\nset-cookie: b\r\n", {"Set-Cookie": "b"}),
    (b"A: caf\xe9\n", {"A": "caf\ufffd"}),
    (b"HTTP/1.0 1\nHTTP/1.1 2\n", {"__HTTP_STATUS__": "HTTP/1.1 2"}),
    (b"", {}),
    (None, {}),
]


def test_http_headers(spark):
    data, expected = zip(*HTTP_HEADERS_CASES)
    assert each(spark, "x binary", data, H.http_headers(F.col("x"))) == list(expected)


@pytest.mark.parametrize("name, expected", [("FOO", "3"), ("b", "2"), ("none", None)])
def test_header_ignores_case(spark, name, expected):
    found = H.header(H.warc_headers(F.col("x")), name)
    assert one(spark, "x binary", b"Foo: 1\nB: 2\nfoo: 3", found) == expected


HTTP_SPLIT_CASES = [
    (RESPONSE, b"H: 1\r\n\r\nB", b"H: 1\r\n", b"B", True),
    (RESPONSE, b"H: 1\n\nB", b"H: 1\n", b"B", True),
    (RESPONSE, b"H: 1\n\nX\r\n\r\nY", b"H: 1\n", b"X\r\n\r\nY", True),
    (RESPONSE, b"H: 1\r\n\r\nX\n\nY", b"H: 1\r\n", b"X\n\nY", True),
    (RESPONSE, b"H: 1\n\r\nB", b"", b"", False),
    (RESPONSE, b"abcdef", b"", b"", False),
    (RESPONSE, b"abc", b"", b"abc", True),
    (RESPONSE, b"\n\na", b"", b"\n\na", True),
    (RESPONSE, b"\n\nabc", b"", b"", False),
    (RESPONSE, b"a\n\nb", b"", b"", False),
    (RESPONSE, b"ab\n\nb", b"ab\n", b"b", True),
    (RESPONSE, b"\n\nab\n\nc", b"\n\nab\n", b"c", True),
    (RESPONSE, b"\n\n\nc", b"", b"", False),
    (RESPONSE, b"\n\n\n\nc", b"\n\n\n", b"c", True),
    (RESPONSE, b"\r\n\r\nB", b"\r\n", b"B", True),
    (RESPONSE, b"\xff: \xe9\r\n\r\n\xff\xfe", b"\xff: \xe9\r\n", b"\xff\xfe", True),
    (RESPONSE, b"H: 1\n\r\n\r\nB", b"H: 1\n\r\n", b"B", True),
    (RESPONSE, b"", b"", b"", True),
    ("application/http; msgtype=request", b"G\r\n\r\nB", None, b"G\r\n\r\nB", True),
    ("application/http; x=y; msgtype=response", b"G\r\n\r\nB", None, b"G\r\n\r\nB", True),
    ("Application/HTTP; msgtype=response", b"G\r\n\r\nB", None, b"G\r\n\r\nB", True),
    (" application/http ;\tmsgtype=response ; x", b"G\r\n\r\nB", b"G\r\n", b"B", True),
    ("application/http", b"abcdef", None, b"abcdef", True),
    (None, b"abcdef", None, b"abcdef", True),
]


def test_http_split(spark):
    rows = [
        (i, {"content-type": c[0]} if c[0] else {}, c[1]) for i, c in enumerate(HTTP_SPLIT_CASES)
    ]
    df = spark.createDataFrame(rows, "i int, warc_headers map<string,string>, content binary")
    as_bytes = lambda b: None if b is None else bytes(b)
    for row in w.split_http(df).collect():
        got = as_bytes(row.http_header_bytes), bytes(row.body), row.http_split_ok
        assert got == HTTP_SPLIT_CASES[row.i][2:], HTTP_SPLIT_CASES[row.i]


def test_stored_length_and_stated_length(scan, spark):
    from archives import response

    data = response(b"hello", length=10**6)
    rows = spark.createDataFrame(
        [("f", 0, "WARC/1.0", data.split(b"\r\n\r\n")[0].split(b"\r\n", 1)[1], b"H: 1\r\n\r\nhello")],
        "source_file string, record_seq bigint, warc_version string, header_block binary, content binary",
    )
    row = w.parse_records(rows, "commoncrawl").first()
    assert row.content_length == 6 + 5 + 2
    assert row.warc_headers["Content-Length"] == "1000000"


def test_missing_id_gets_the_same_stand_in_every_time(scan, spark, tmp_path):
    from archives import GAP, record

    (tmp_path / "a.warc").write_bytes(record(rid=None) + GAP + record(rid=None) + GAP + record())
    parsed = w.parse_headers(w.read_warc(spark, str(tmp_path)), "commoncrawl")
    ids = [r.record_id for r in parsed.orderBy("record_seq").collect()]
    again = [r.record_id for r in parsed.orderBy("record_seq").collect()]
    assert ids == again and len(set(ids)) == 3
    assert ids[0].startswith("<urn:uuid:") and ids[2] == "<urn:uuid:1>"
    place = f"file:{tmp_path}/a.warc#1"
    assert ids[1] == f"<urn:uuid:{one(spark, 'x string', place, name_uuid(F.col('x')))}>"


def test_record_text(spark):
    df = spark.createDataFrame(
        [({"B": "2", "a": "1"}, b"H: 1\r\n", "text")], "m map<string,string>, h binary, t string"
    )
    head, body = df.select(
        H.warc_header_text(F.lit("WARC/1.0"), F.col("m")), H.record_text(F.col("h"), F.col("t"))
    ).first()
    assert sorted(head.split("\r\n")) == ["", "B: 2", "WARC/1.0", "a: 1"]
    assert body == "H: 1\r\n\r\ntext"


def test_filters_do_not_repeat_the_header_map(spark):
    """A filter on the record type neither copies the map nor waits for the body."""
    records = spark.createDataFrame(
        [], "source_file string, record_seq bigint, warc_version string, header_block binary, content binary"
    )
    kept = w.keep_http_records(w.parse_records(records, "commoncrawl"))
    plan = kept.select("record_id", "body")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sort_array") == 1
    assert plan.index("Filter") > plan.index("substring_index")
