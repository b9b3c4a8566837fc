import json
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from changeloom.functions import cityhash as H
from changeloom.functions import convert as C
from changeloom.functions import redact as R
from changeloom.functions.types import SourceColumn, TargetColumn, base_name, unwrap

M = (1 << 64) - 1


def plain_city(s: bytes) -> int:
    """The published algorithm, one value at a time."""
    k0, k1, k2, k3 = (int(k) for k in (H.K0, H.K1, H.K2, H.K3))
    f = lambda i, n=8: int.from_bytes(s[i : i + n], "little")
    rot = lambda v, n: v if n == 0 else (v >> n | v << (64 - n)) & M
    mix = lambda v: v ^ v >> 47

    def to64(u, v):
        a = (u ^ v) * int(H.KMUL) & M
        a ^= a >> 47
        b = (v ^ a) * int(H.KMUL) & M
        return (b ^ b >> 47) * int(H.KMUL) & M

    def weak(i, a, b):
        w, x, y, z = f(i), f(i + 8), f(i + 16), f(i + 24)
        a = a + w & M
        b = rot(b + a + z & M, 21)
        c = a
        a = a + x + y & M
        return a + z & M, b + rot(a, 44) + c & M

    n = len(s)
    if n <= 16:
        if n > 8:
            a, b = f(0), f(n - 8)
            return to64(a, rot(b + n & M, n)) ^ b
        if n >= 4:
            return to64(n + (f(0, 4) << 3), f(n - 4, 4))
        if n:
            return mix((s[0] + (s[n >> 1] << 8)) * k2 & M ^ (n + (s[n - 1] << 2)) * k3 & M) * k2 & M
        return k2
    if n <= 32:
        a, b, c, d = f(0) * k1 & M, f(8), f(n - 8) * k2 & M, f(n - 16) * k0 & M
        return to64(rot(a - b & M, 43) + rot(c, 30) + d & M, a + rot(b ^ k3, 20) - c + n & M)
    if n <= 64:
        z, a = f(24), f(0) + (n + f(n - 16)) * k0 & M
        b, c = rot(a + z & M, 52), rot(a, 37)
        a = a + f(8) & M
        c = c + rot(a, 7) & M
        a = a + f(16) & M
        vf, vs = a + z & M, b + rot(a, 31) + c & M
        a, z = f(16) + f(n - 32) & M, f(n - 8)
        b, c = rot(a + z & M, 52), rot(a, 37)
        a = a + f(n - 24) & M
        c = c + rot(a, 7) & M
        a = a + f(n - 16) & M
        wf, ws = a + z & M, b + rot(a, 31) + c & M
        return mix(mix((vf + ws) * k2 + (wf + vs) * k0 & M) * k0 + vs & M) * k2 & M
    x, y, z = f(0), f(n - 16) ^ k1, f(n - 56) ^ k0
    v, w = weak(n - 64, n, y), weak(n - 32, n * k1 & M, k0)
    z = z + mix(v[1]) * k1 & M
    x, y = rot(z + x & M, 39) * k1 & M, rot(y, 33) * k1 & M
    for i in range(0, (n - 1) & ~63, 64):
        x = rot(x + y + v[0] + f(i + 16) & M, 37) * k1 & M
        y = rot(y + v[1] + f(i + 48) & M, 42) * k1 & M
        x ^= w[1]
        y ^= v[0]
        z = rot(z ^ w[0], 33)
        v = weak(i, v[1] * k1 & M, x + w[0])
        w = weak(i + 32, z + w[1], y)
        z, x = x, z
    return to64(to64(v[0], w[0]) + mix(y) * k1 + z & M, to64(v[1], w[1]) + x & M)


def test_empty_text_has_the_published_hash():
    assert H.city_hash64(pa.array(["", None])).tolist() == [0x9AE16A3B2F90404F] * 2


@given(st.lists(st.binary(max_size=300), min_size=1, max_size=40))
def test_batches_hash_like_single_values(values):
    assert H.city_hash64(pa.array(values, pa.binary())).tolist() == [plain_city(v) for v in values]


def test_every_length_and_slices():
    rng = np.random.default_rng(0)
    values = [rng.bytes(n) for n in range(260)]
    array = pa.array(values, pa.binary())
    want = [plain_city(v) for v in values]
    assert H.city_hash64(array).tolist() == want and len(set(want)) == 260
    assert H.city_hash64(array.slice(7, 100)).tolist() == want[7:107]
    assert H.city_hash64(array[:0]).tolist() == []


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).first().v


def value(spark, text, source, target, **kw):
    t = TargetColumn("x", target)
    return one(spark, C.null_default(C.convert(F.lit(text), SourceColumn("x", source), t, **kw), t))


@pytest.mark.parametrize(
    ("text", "source", "target", "want"),
    [
        ("2400-01-02 15:04:05", "datetime", "DateTime64(3)", "2261-01-02 15:04:05"),
        ("2023-01-02 15:04:05.25", "datetime", "DateTime64", "2023-01-02 15:04:05.250000"),
        ("2400-02-29 01:02:03", "timestamp", "DateTime", "2105-03-01 01:02:03"),
        ("0001-01-22 00:00:00", "datetime", "Nullable(DateTime64(3))", "1925-01-22 00:00:00"),
        ("1890-06-07", "date", "Date", "1970-06-07"),
        ("0000-00-00 00:00:00", "datetime", "DateTime", "1970-01-01 00:00:00"),
        ("", "datetime", "Nullable(DateTime)", "None"),
        ("10.21", "decimal(10,2)", "Int64", "1021"),
        ("-0.05", "decimal(10,2)", "Nullable(Int32)", "-5"),
        ("10.21", "decimal(10,2)", "Float64", "10.21"),
        ("10.21", "decimal(10,2)", "Decimal(10, 2)", "10.21"),
        ("10.21", "decimal(10,2)", "String", "10.21"),
        ("309", "bigint", "Int32", "309"),
        ("65", "int", "String", "65"),
        ("18446744073709551615", "bigint unsigned", "UInt64", "18446744073709551615"),
        (None, "int", "Int32", "0"),
        (None, "int", "Nullable(Int32)", "None"),
        (None, "varchar(10)", "LowCardinality(String)", ""),
        (None, "decimal(10,2)", "Nullable(Decimal(10, 2))", "None"),
        (None, "datetime", "DateTime", "1970-01-01 00:00:00"),
        ("test string", "blob", "String", "test string"),
        ("1", "tinyint", "Bool", "True"),
        ("[1, 2]", "json", "Array(Int32)", "[1, 2]"),
    ],
)
def test_conversions(spark, text, source, target, want):
    assert str(value(spark, text, source, target)) == want


def test_range_and_strictness(spark):
    for text, target in (("300", "UInt8"), ("-1", "UInt32"), ("40000", "Int16")):
        with pytest.raises(PySparkException):
            value(spark, text, "int", target)
    assert value(spark, "300", "int", "UInt8", wrap=True) == 44
    assert value(spark, "-1", "int", "UInt32", wrap=True) == 4294967295
    assert value(spark, "40000", "int", "Int16", wrap=True) == 40000 - 65536
    with pytest.raises(PySparkException):
        value(spark, "0000-00-00", "date", "Date", strict=True)


def test_types():
    assert base_name("Nullable(DateTime64(3))") == "Nullable" and unwrap("LowCardinality(Nullable(String))") == ("String", True)
    c = TargetColumn("x", "Nullable(Decimal64(4))")
    assert c.nullable and c.spark_type.simpleString() == "decimal(18,4)" and c.is_decimal and not c.is_int
    assert TargetColumn("x", "UInt64").integer_range == (0, 2**64 - 1) and TargetColumn("x", "Int8").integer_range == (-128, 127)
    with pytest.raises(ValueError):
        TargetColumn("x", "Quaternion").spark_type


RULES = R.Redaction((".*(password|email|address).*",), (".*(password)_type$",))


def test_yaml(spark):
    found = json.loads(R.yaml_to_json("password: test\nemail: a@b.c\n:firstname: max\nyes: no\nn: 012\nwhen: 2020-01-01\nf: 1.5\nt: true\nz:\n", "t.doc", RULES))
    assert found["firstname"] == "max" and found["yes"] == "no" and found["n"] == "012" and found["when"] == "2020-01-01"
    assert found["f"] == 1.5 and found["t"] is True and found["z"] is None
    assert found["password"] == int(H.city_hash64(pa.array(["test"]))[0]) and isinstance(found["email"], int)
    ruby = json.loads(R.yaml_to_json("--- !ruby/hash:ActiveSupport::HashWithIndifferentAccess\nfirstname: Mr\nlast: Person\n", "t.doc", RULES))
    assert ruby == {"firstname": "Mr", "last": "Person"}
    odd = json.loads(R.yaml_to_json(":font: “Abril”\nx: !custom {a: [1, ~, {}]}\n'': e\n", "t.doc", RULES))
    assert odd == {"font": "“Abril”", "x": {"a": [1, None, {}]}, "": "e"}
    assert set(json.loads(R.yaml_to_json("{a: [", "t.doc", RULES))) == {"rawYaml", "errorParsingYaml"}
    assert R.yaml_to_json("", "t.doc", RULES) == "{}" and R.yaml_to_json(None, "t.doc", RULES) is None


def test_nested_redaction():
    doc = "orders:\n- :address: {street: 2 Rose Cottages, n: 4, tags: [x]}\n  empty: {}\n  password_type: plain\n"
    text = R.yaml_to_json(doc, "t.doc", RULES)
    found = json.loads(text)["orders"][0]
    assert "Rose" not in text and isinstance(found["address"]["street"], int) and found["address"]["n"] == 4
    assert isinstance(found["address"]["tags"][0], int) and found["empty"] == {} and found["password_type"] == "plain"
    # anchored patterns meet keys with and without their colon
    for pattern in (r"^t\.doc\.:who$", r"^t\.doc\.who$"):
        assert isinstance(json.loads(R.yaml_to_json(":who: me", "t.doc", R.Redaction((pattern,))))["who"], int)
    assert json.loads(R.yaml_to_json(":a: 1\na: 2\n", "t.doc", RULES)) == {"a": 2}
    assert json.loads(R.json_document('[{"email": "x", "k": "y"}]', "t.doc", RULES))[0]["k"] == "y"


def test_hash_column(spark):
    df = spark.createDataFrame([("test",), (None,), ("",), ("x" * 100_000,)], "v string")
    got = [r.h for r in df.select(R.hash_text(F.col("v")).alias("h")).collect()]
    assert got == [None if v is None else str(plain_city(v.encode())) for v in ("test", None, "", "x" * 100_000)]


def test_hash_of_published_values():
    """What other implementations of version 1.0.2 give: the empty text (K2) and one in a manual."""
    assert H.city_hash64(pa.array(["", "Moscow"])).tolist() == [11160318154034397263, 12507901496292878638]


def test_documents_of_a_batch_are_hashed_together():
    docs = [":password: a\nx: [b, {email: c}]\n", None, "password: a\n", "{a: [", ""]
    each = [R.yaml_to_json(d, "t.doc", RULES) for d in docs]
    assert R.redact_documents(docs, "t.doc", RULES, True) == each and each[1] is None
    assert json.loads(each[0])["password"] == json.loads(each[2])["password"] == int(H.city_hash64(pa.array(["a"]))[0])
    bad = R.redact_documents(["{no json", '{"email": "q", "n": 1}', None], "t.doc", RULES, False)
    assert bad == [str(int(H.city_hash64(pa.array(["{no json"]))[0])), json.dumps({"email": int(H.city_hash64(pa.array(["q"]))[0]), "n": 1}), None]


def test_patterns_are_unanchored_and_picklable():
    import pickle

    p = pickle.loads(pickle.dumps(R.Patterns(("pass", "^a"))))
    assert p.matches("t.password") and p.matches("abc") and not p.matches("t.other") and not R.Patterns()


def test_decimals_keep_digits(spark):
    assert value(spark, "12345678901234567.89", "decimal(19,2)", "Decimal(19, 2)") == Decimal("12345678901234567.89")
    assert value(spark, "12345678901234567.89", "decimal(19,2)", "Int64") == 1234567890123456789
