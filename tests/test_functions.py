"""Column helpers against Python references."""

import base64
import datetime as dt
import hashlib
import hmac
from decimal import Decimal


from basketry.functions import columns as C


def test_hmac_matches_python(spark):
    msgs = ["{}", '{"sessionId":"x","userId":1}', "héllo wörld", "a" * 300]
    df = spark.createDataFrame([(m,) for m in msgs], "m string")
    got = [r[0] for r in df.select(C.hmac_b64("m", "k3y", 256)).collect()]
    exp = [base64.b64encode(hmac.new(b"k3y", m.encode(), hashlib.sha256).digest()).decode() for m in msgs]
    assert got == exp
    long_key = "x" * 200
    got512 = [r[0] for r in df.select(C.hmac_b64("m", long_key, 512)).collect()]
    exp512 = [base64.b64encode(hmac.new(long_key.encode(), m.encode(), hashlib.sha512).digest()).decode()
              for m in msgs]
    assert got512 == exp512


def test_parse_price_java_rules(spark):
    vals = [" 1.5 ", "1.23456", "abc", "", None, "2", "-0.5", "1e2"]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    got = [r[0] for r in df.select(C.parse_price("t")).collect()]
    assert got == [Decimal("0.0000"), Decimal("1.2346"), Decimal("0.0000"), Decimal("0.0000"), Decimal("0.0000"),
                   Decimal("2.0000"), Decimal("-0.5000"), Decimal("100.0000")]


def test_iso_instant_java_style(spark):
    ts = [dt.datetime(2024, 1, 1, 0, 0, 7), dt.datetime(2024, 1, 1, 0, 0, 7, 179000),
          dt.datetime(2024, 1, 1, 0, 0, 7, 179575)]
    df = spark.createDataFrame([(t,) for t in ts], "t timestamp_ntz")
    got = [r[0] for r in df.select(C.iso_instant("t")).collect()]
    assert got == ["2024-01-01T00:00:07Z", "2024-01-01T00:00:07.179Z", "2024-01-01T00:00:07.179575Z"]


def test_parse_ids(spark):
    df = spark.createDataFrame([("12",), ("+7",), ("x",), ("1-2-3-4-5",), ("ABCDEF12-1-2-3-4",)], "t string")
    got = df.select(C.parse_long("t"), C.parse_uuid("t")).collect()
    assert [r[0] for r in got] == [12, 7, None, None, None]
    assert got[3][1] == "00000001-0002-0003-0004-000000000005"
    assert got[4][1] == "abcdef12-0001-0002-0003-000000000004"


def test_sha256_hex(spark):
    df = spark.createDataFrame([("tok",)], "t string")
    assert df.select(C.sha256_hex("t")).first()[0] == hashlib.sha256(b"tok").hexdigest()
