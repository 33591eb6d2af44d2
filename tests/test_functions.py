"""Scalar functions against goldens and plain Python."""

import datetime
import random

import pytest
from blockloom import functions as fn
from blockloom.functions.hashing import keccak256
from pyspark.sql import functions as F

TRANSFER = "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"


def values(spark, rows, column, kind="string"):
    """``column`` over single values, in order."""
    df = spark.createDataFrame(list(enumerate(rows)), f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def python_number(text):
    if text is None:
        return None
    text = text.strip()
    if not text or text == "0x":
        return None
    try:
        number = int(text, 16) if text.startswith("0x") else int(text, 10)
    except ValueError:
        return None
    return number


NUMBER_TEXTS = [
    None, "", "0x", "   ", "0xzz", "12ab", " 0x1F ", "0x1f", "0X1f", "31", " 31\n", "+5", "-7", "--7", "1_000",
    "0x1_f", "0x_1f", "1__0", "_1", "1_", "0x00000000000000000001", "0x7fffffffffffffff", "9223372036854775807",
    "1e5", "1.5", "0x 1", "zz", "0", "0x0", "-0x1f", "007",
]


def test_parse_number(spark):
    assert values(spark, NUMBER_TEXTS, fn.parse_number(F.col("x"))) == [python_number(t) for t in NUMBER_TEXTS]


def test_parse_number_beyond_bigint_is_null(spark):
    texts = ["0x8000000000000000", "9223372036854775808", "0x" + "f" * 40]
    assert values(spark, texts, fn.parse_number(F.col("x"))) == [None] * 3


def test_parse_wide_number(spark):
    wide = ["0x8000000000000000", "0x" + "f" * 16, "0x1" + "0" * 16, "5" + "0" * 30, "0x4b3b4ca85a86c47a098a223fffffffff"]
    texts = NUMBER_TEXTS + wide
    got = values(spark, texts, fn.parse_wide_number(F.col("x")))
    assert [None if g is None else int(g) for g in got] == [python_number(t) for t in texts]
    too_wide = ["0x" + "f" * 32, "0x1" + "0" * 32, "1" + "0" * 38]
    assert values(spark, too_wide, fn.parse_wide_number(F.col("x"))) == [None] * 3


def python_double(text):
    """Digit by digit from the least, as floats."""
    if text is None:
        return None
    digits = text.replace("0x", "").lower()
    terms = ["0123456789abcdef".find(d) * 16.0**p for p, d in enumerate(reversed(digits)) if d in "0123456789abcdef"]
    if not terms:
        return None
    total = 0.0
    for term in terms:
        total += term
    return total


def random_words(count):
    rng = random.Random(7)
    return ["0x" + "".join(rng.choice("0123456789abcdef") for _ in range(rng.randint(1, 64))) for _ in range(count)]


def test_uint256_to_double_is_bit_equal(spark):
    odd = [None, "", "0x", "zz", "0x1g", "0x" + "f" * 64, "0x" + "0" * 64, "0xFF", "ff", "0x" + "1" * 100, "é1", "0x0x12"]
    words = odd + random_words(3000)
    assert values(spark, words, fn.uint256_to_double(F.col("x"))) == [python_double(w) for w in words]


def test_uint256_to_double_past_range_is_null(spark):
    assert values(spark, ["0x" + "f" * 300], fn.uint256_to_double(F.col("x"))) == [None]


def test_hex_to_numeric_is_exact(spark):
    words = random_words(3000) + ["0x" + "f" * 64, "0x" + "ab" * 3000]
    expected = [int(w, 16) for w in words]
    got = values(spark, words, fn.hex_to_numeric(F.col("x")))
    import sys

    sys.set_int_max_str_digits(0)
    assert [int(g) for g in got] == expected
    edge = values(spark, [None, "0x", "", "0x1g", "0X1", "FF"], fn.hex_to_numeric(F.col("x")))
    assert edge == [None, "0", "0", None, None, "255"]


def test_hex_to_decimal(spark):
    got = values(spark, ["0x0de0b6b3a7640000", "0x" + "f" * 64], fn.hex_to_decimal(F.col("x")))
    assert got == [10**18, None]


def test_uint256_to_address(spark):
    words = ["0x00000000000000000000000066f66192f91eaa3d48c95ab6bdaf9ade26db06f1", None, "0x12"]
    got = values(spark, words, fn.uint256_to_address(F.col("x")))
    assert got == ["0x66f66192f91eaa3d48c95ab6bdaf9ade26db06f1", None, "0x"]


def test_address_helpers(spark):
    zero = "0x" + "0" * 40
    assert values(spark, [zero, "0x1", None], fn.is_zero_address(F.col("x"))) == [True, False, None]
    assert values(spark, ["ab", "0xab", None], fn.with_0x(F.col("x"))) == ["0xab", "0xab", None]
    assert values(spark, ["0xab", "ab", "0x"], fn.extract_hex_data(F.col("x"))) == ["ab", "ab", ""]
    assert values(spark, ["0xff", "ff", "0x", "zz"], fn.hex_to_bigint(F.col("x"))) == [255, 255, None, None]


def test_whole_number_truncates(spark):
    got = values(spark, ["12.9", "-12.9", "x", None, "1e30"], fn.whole_number(F.col("x")))
    assert got == [12, -12, None, None, None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["1704067200", "1704067200.9", "2024-01-01T00:00:00.000Z", "2024-01-01T02:00:00+02:00",
                 "2024-01-01 00:00:00", "nope", None, "99999999999999"]
        noon = datetime.datetime(2024, 1, 1)
        assert values(spark, texts, fn.as_datetime(F.col("x"))) == [noon] * 5 + [None] * 3
        assert values(spark, [1704067200, None], fn.epoch_datetime(F.col("x")), "bigint") == [noon, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_json_helpers(spark):
    texts = ['["a",null]', "[]", "nope", None]
    assert values(spark, texts, fn.topic_at(fn.json_array(F.col("x")), 1)) == [None] * 4
    assert values(spark, texts, fn.topic_at(fn.json_array(F.col("x")), 0)) == ["a", None, None, None]
    maps = ['{"b":1,"a":{"c":2}}', "{}", "[]"]
    assert values(spark, maps, fn.first_value(fn.json_map(F.col("x")))) == ["1", None, None]
    assert values(spark, maps, fn.lookup(fn.json_map(F.col("x")), F.lit("a"))) == ['{"c":2}', None, None]
    mixed = ['{"d":[{"a":1},5]}', '{"d":[{"a":1},{}]}', '{"d":null}']
    assert values(spark, mixed, fn.json_objects(F.col("x"), "d")) == [[{"a": "1"}, None], [{"a": "1"}, {}], None]


def test_keccak_goldens():
    assert keccak256([b"Transfer(address,address,uint256)"]) == [TRANSFER]
    # Published digest of the empty message.
    assert keccak256([b""]) == ["0xc5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470"]


def test_keccak_batches_mix_lengths(spark):
    texts = ["", "a" * 135, "b" * 136, "c" * 137, "d" * 500, "é"]
    alone = [keccak256([t.encode()])[0] for t in texts]
    assert keccak256([t.encode() for t in texts]) == alone
    assert len(set(alone)) == len(texts)
    assert values(spark, [None, *texts, *texts], fn.keccak256_hex(F.col("x"))) == [None, *alone, *alone]


def test_registered_functions_agree_with_columns(spark):
    names = fn.register(spark)
    df = spark.createDataFrame([(t,) for t in NUMBER_TEXTS], "x string")
    pairs = {
        "parse_num": fn.parse_number,
        "uint256_to_address": fn.uint256_to_address,
        "from_uint256_to_address": fn.uint256_to_address,
        "extract_hex_data": fn.extract_hex_data,
        "hex_to_bigint": fn.hex_to_bigint,
        "is_zero_address": fn.is_zero_address,
        "uint256_to_numeric": fn.uint256_to_double,
        "hex_to_numeric": fn.hex_to_numeric,
        "keccak256_hex": fn.keccak256_hex,
    }
    assert sorted(pairs) == names
    for name, column in pairs.items():
        both = df.select(F.expr(f"{name}(x)").alias("a"), column(F.col("x")).alias("b"))
        assert both.where("not (a <=> b)").count() == 0, name
