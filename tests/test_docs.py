"""Encodings, decoding and documents."""

import base64
import json
import uuid

import pytest
from pyspark.sql import functions as F

import warcloom as w
from warcloom.functions import charset as C
from warcloom.functions import identity as I

SCHEMA = (
    "source_file string, record_seq bigint, record_id string, record_type string, target_uri string, "
    "warc_headers map<string,string>, http_headers map<string,string>, body binary"
)


def docs(spark, cases, **kw):
    """Documents of (body, content type, record type), in order."""
    rows = [
        ("f", i, "<id>", kind, "http://x/", {"WARC-Type": kind}, {"content-type": t} if t is not None else {}, b)
        for i, (b, t, kind) in enumerate(cases)
    ]
    return w.build_docs(spark.createDataFrame(rows, SCHEMA), "cw12", **kw).orderBy("record_seq").collect()


def doc(spark, body, content_type=None, kind="response", **kw):
    return docs(spark, [(body, content_type, kind)], **kw)[0]


def b64(data):
    return base64.b64encode(data).decode()


BODIES_CASES = [
    (b"a\xc3\xa9", None, "request", "US-ASCII", "a\ufffd\ufffd", "plain", False),
    ("é".encode(), "text/html; charset=utf-8", "response", "UTF-8", "é", "plain", False),
    ("é".encode(), "text/html; a=b; charset=utf-8", "response", "UTF-8", "é", "plain", False),
    ("é".encode(), "text/html; charset=utf8 ; charset=x", "response", "UTF8", "é", "plain", False),
    (b"caf\xe9", "charset=utf-8", "response", "ISO-8859-1", "café", "plain", False),
    (b"caf\xe9", "text/html; Charset=utf-8", "response", "ISO-8859-1", "café", "plain", False),
    (b"abc", 'text/html; charset="utf-8"', "response", '"UTF-8"', b64(b"abc"), "plain", True),
    (b"abc", "text/html; charset=no-such-charset", "response", "NO-SUCH-CHARSET", b64(b"abc"), "plain", True),
    (b"abc", "text/html; charset=", "response", "", b64(b"abc"), "plain", True),
    (b"abc", "text/html; charset=a, b]", "response", "A, B]", b64(b"abc"), "plain", True),
    (b"A\x93", "text/html; charset=windows-1252", "response", "WINDOWS-1252", "A\u201c", "plain", False),
    (b"\xc4\xe3", "text/html; charset=gb2312", "response", "GB2312", "你", "plain", False),
    (b"\x82\xa0", "text/html;charset=Shift_JIS", "response", "SHIFT_JIS", "あ", "plain", False),
    (b"\xcf\xf0", "text/html; charset=koi8-r", "response", "KOI8-R", "оП", "plain", False),
    (b"A\xffB", "text/html; charset=utf-8", "response", "UTF-8", "A\ufffdB", "plain", False),
    ("né€😀".encode(), None, "response", "UTF-8", "né€😀", "plain", False),
    (b"caf\xe9", None, "response", "ISO-8859-1", "café", "plain", False),
    (b"plain", "text/html", "response", "ISO-8859-1", "plain", "plain", False),
    (b"\xff" + b"\x01" * 6, None, "response", None, b64(b"\xff" + b"\x01" * 6), "base64", True),
    (b"\xff" + b"\x01" * 5, None, "response", "ISO-8859-1", "ÿ" + "\x01" * 5, "plain", False),
    (b"\xff" + b"\x85" * 6, None, "response", None, b64(b"\xff" + b"\x85" * 6), "base64", True),
    (b"a" * 512 + b"\x01" * 9, None, "response", "ISO-8859-1", "a" * 512 + "\x01" * 9, "plain", False),
    (b"\x09\x0a\x0b\x0c\x0d" * 3, None, "response", "ISO-8859-1", "\t\n\x0b\x0c\r" * 3, "plain", False),
    (b"\x00" * 8, None, "response", None, b64(b"\x00" * 8), "base64", True),
    (b"\xef\xbb\xbfa", None, "response", "UTF-8", "\ufeffa", "plain", False),
    (b"\xff\xfea\x00", None, "response", "UTF-16LE", "\ufeffa", "plain", False),
    (b"\xfe\xff\x00a", None, "response", "UTF-16BE", "\ufeffa", "plain", False),
    (b"", None, "response", "ISO-8859-1", "", "plain", False),
    (b"", "text/html; charset=nope", "response", "NOPE", "", "plain", False),
    (b"\x80" * 100, "text/html; charset=nope", "response", "NOPE", b64(b"\x80" * 100), "plain", True),
]


def test_bodies(spark):
    rows = docs(spark, [c[:3] for c in BODIES_CASES])
    for case, row in zip(BODIES_CASES, rows, strict=True):
        got = row.encoding, row.body_text, row.body_encoding, row.body_is_base64
        assert got == case[3:], case
        payload = json.loads(row.json)["payload"]
        assert (payload["body"], payload["encoding"]) == got[1:3]


def test_json_shape(spark):
    row = doc(spark, "é\"\n".encode(), "text/html; charset=utf-8")
    assert json.loads(row.json) == {
        "metadata": {"WARC-Type": "response"},
        "payload": {
            "headers": {"content-type": "text/html; charset=utf-8"},
            "body": "é\"\n",
            "encoding": "plain",
        },
    }
    assert row.doc.payload.body == "é\"\n"


def test_long_base64_has_no_breaks(spark):
    text = doc(spark, b"\x00" * 100).body_text
    assert len(text) == 136 and "\n" not in text


def test_caller_supplied_detector(spark):
    @F.pandas_udf("string")
    def koi(bodies):
        return bodies.map(lambda b: "KOI8-R")

    assert doc(spark, b"\xcf\xf0", detector=koi).body_text == "оП"


def test_session_settings_are_put_back(spark):
    spark.conf.set("spark.sql.legacy.javaCharsets", "false")
    doc(spark, b"x")
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == "false"
    spark.conf.unset("spark.sql.legacy.javaCharsets")
    doc(spark, b"x")
    assert spark.conf.get("spark.sql.legacy.codingErrorAction", None) is None


@pytest.mark.parametrize(
    "key, value, part",
    [
        ("hello", 99162322, 2),
        ("", 0, 0),
        ("x" * 300, -1757771264, 0),
        ("http://exämple.com/ü", -247320997, 11),
        ("a😀b", 57849694, 14),
        (None, None, None),
    ],
)
def test_hash_and_partition(spark, key, value, part):
    df = spark.createDataFrame([(key,)], "k string")
    row = df.select(I.java_hash(F.col("k")), I.partition_id(F.col("k"), 16)).first()
    assert tuple(row) == (value, part) or key is None and row[1] is None


def test_doc_uuid(spark):
    df = spark.createDataFrame([("clueweb12-0000",), (None,), ("ü",)], "id string")
    got = [r[0] for r in df.select(I.doc_uuid("cw12", F.col("id"))).collect()]
    expected = [str(uuid.uuid5(uuid.NAMESPACE_URL, f"cw12:{i}")) for i in ("clueweb12-0000", "ü")]
    assert got == [expected[0], None, expected[1]]
    assert got[0] == "057e5df9-b18c-5f77-9853-55e0eb699dd6"


def test_split_and_segment_names(spark):
    df = spark.createDataFrame([("data", 12), ("uri", 0)], "t string, p int")
    rows = df.select(
        I.split_name(F.col("t"), F.col("p")).alias("n"), I.segment_name(F.col("p")).alias("s")
    ).select("n", "s", I.split_partition(F.col("n")).alias("p"))
    assert [tuple(r) for r in rows.collect()] == [
        ("data-r-00012", "segment-00012", 12),
        ("uri-r-00000", "segment-00000", 0),
    ]


def test_known_charsets_include_aliases(spark):
    names = C._jvm_charsets()
    assert {"UTF-8", "UTF8", "LATIN1", "WINDOWS-1252", "CP1252", "BIG5", "GB18030"} <= set(names)
