import datetime
import random
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import codec, formats, retry, sequences
from millrace.functions.formats import form_body

CASES = {
    "tinyint": [-128, -1, 0, 127, None],
    "smallint": [-32768, 5, None],
    "int": [-(2**31), 2**31 - 1, None],
    "bigint": [-(2**63), -1, 0, 2**63 - 1, None],
    "boolean": [True, False, None],
    "string": ["", "a", "日本", None],
    "binary": [bytearray(b"\x00\xff"), None],
    "double": [-0.0, 1.5, float("inf"), float("-inf"), 5e-324, None],
    "float": [1.5, -2.25, float("-inf"), None],
    "decimal(5,0)": [Decimal(-99999), Decimal(127), Decimal(128), Decimal(-128), Decimal(-129), Decimal(0), None],
    "decimal(18,4)": [Decimal("99999999999999.9999"), Decimal("-99999999999999.9999"), Decimal("-0.0001"), None],
    "timestamp_ntz": [datetime.datetime(1969, 12, 31, 23, 59, 59, 999000), datetime.datetime(2024, 3, 10, 2, 30), datetime.datetime(1900, 1, 1), None],
    "decimal(20,3)": [Decimal("-12345678901234567.891"), Decimal("0.000"), Decimal("-0.128"), None],
    "date": [datetime.date(1960, 1, 1), datetime.date(2024, 2, 29), None],
    "timestamp": [datetime.datetime(1969, 12, 31, 23, 59, 59, 999000), datetime.datetime(2024, 1, 1), None],
}


@pytest.mark.parametrize("kind", CASES)
def test_cells_round_trip(spark, kind):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(CASES[kind])], f"i int, v {kind}")
    out = df.select("i", codec.decode_cell(codec.encode_cell(F.col("v"), kind), kind).alias("v")).orderBy("i").collect()
    assert [r["v"] for r in out] == CASES[kind]


def test_nan_is_no_null(spark):
    df = spark.createDataFrame([(0, float("nan")), (1, None), (2, 1.0)], "i int, v double").repartition(1)
    for kind, nan in (("double", "7FF8000000000000"), ("float", "7FC00000")):
        cell = codec.encode_cell(F.col("v").cast(kind), kind)
        rows = df.select("i", F.hex(cell).alias("c"), codec.decode_cell(cell, kind).alias("v")).orderBy("i").collect()
        assert [r["c"] for r in rows][:2] == [nan, ""] and rows[0]["v"] != rows[0]["v"] and rows[1]["v"] is None and rows[2]["v"] == 1.0


def test_the_session_zone_changes_nothing(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    seen = set()
    try:
        for name in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", name)
            at = F.timestamp_micros(F.lit(1_710_052_200_000_000))  # an hour that New York skips
            local = F.lit("2024-03-10 02:30:00").cast("timestamp_ntz")
            back = codec.decode_cell(codec.encode_cell(local, "timestamp_ntz"), "timestamp_ntz")
            row = spark.range(1).select(
                F.hex(codec.encode_cell(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), "timestamp_ntz")).alias("zero"),
                F.hex(codec.encode_cell(local, "timestamp_ntz")).alias("local"),
                (back == local).alias("same"),
                F.hex(codec.encode_cell(at, "timestamp")).alias("at"),
                formats.json_body(F.timestamp_micros(F.lit(0)).alias("t"), local.alias("l")).alias("json"),
            ).first()
            seen.add(tuple(row))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert seen == {("0" * 16, f"{1_710_037_800_000:016X}", True, f"{1_710_052_200_000:016X}", '{"t":"1970-01-01T00:00:00.000000Z","l":"2024-03-10T02:30:00.000000"}')}


def test_decimals_of_another_scale_are_read(spark):
    for written, read in (("decimal(9,4)", "decimal(12,2)"), ("decimal(30,2)", "decimal(18,2)"), ("decimal(9,1)", "decimal(30,5)")):
        cell = codec.encode_cell(F.lit(Decimal("-12.50")).cast(written), written)
        assert spark.range(1).select(codec.decode_cell(cell, read).alias("v")).first()["v"] == Decimal("-12.50")


def test_narrowing_and_truncation(spark):
    df = spark.createDataFrame([(127, 1_999_999_999), (-128, -1), (None, None)], "v long, n long")
    rows = df.select(formats.narrowed(F.col("v"), "tinyint").alias("v"), formats.truncated_time(F.col("n"), 0).alias("s"), F.unix_micros(formats.timestamp_from_nanos(F.col("n"), 9)).alias("t")).collect()
    assert [tuple(r) for r in rows] == [(127, 1_000_000_000, 1_999_999), (-128, -1_000_000_000, -1), (None, None, None)]
    for v, kind in ((128, "tinyint"), (-32769, "smallint"), (2**31, "int")):
        with pytest.raises(Exception, match="does not fit"):
            spark.range(1).select(formats.narrowed(F.lit(v).cast("bigint"), kind)).collect()


def test_qualified_names():
    assert formats.table_identifier("`a.b`.C") == ("a.b", "C") and formats.table_identifier('S."T.x"', "postgres") == ("s", "T.x")
    for wrong in ("a..b", "`a", ""):
        with pytest.raises(ValueError):
            formats.table_identifier(wrong)


def test_cell_layouts(spark):
    row = spark.range(1).select(
        F.hex(codec.encode_cell(F.lit(-2).cast("int"), "int")).alias("i"),
        F.hex(codec.encode_cell(F.lit(Decimal("-1.28")).cast("decimal(5,2)"), "decimal(5,2)")).alias("d"),
        F.hex(codec.encode_cell(F.lit(None).cast("string"), "string")).alias("n"),
        codec.decode_cell(F.unhex(F.lit("07")), "boolean").alias("b"),
        codec.decode_cell(F.unhex(F.lit("0000002AFFFF")), "int").alias("tail"),
    ).first()
    assert (row["i"], row["d"], bytes.fromhex(row["n"]), row["b"], row["tail"]) == ("FFFFFFFE", "0000000280", b"null", True, 42)
    with pytest.raises(Exception, match="a cell of 8 bytes"):
        spark.range(1).select(codec.decode_cell(F.unhex(F.lit("00")), "bigint")).collect()
    with pytest.raises(ValueError):
        codec.encode_cell(F.lit(1), "array<int>")


def test_decimal_overflow_is_an_error(spark):
    cell = codec.encode_cell(F.lit(Decimal("123456.78")).cast("decimal(8,2)"), "decimal(8,2)")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|out of range|cannot be represented"):
        spark.range(1).select(codec.decode_cell(cell, "decimal(4,2)")).collect()


def test_commit_sequence_known_value(spark):
    nanos = 1670955531785000000
    row = spark.range(1).select(sequences.from_commit(F.lit(nanos), F.lit("1"), F.lit(0)).alias("s")).first()
    assert row["s"] == "17306D33FB84D440/0000000000000001/0000000000000000"


def test_sequences_refuse(spark):
    one = spark.range(1)
    for bad in (
        sequences.sections(F.lit(-1)),
        sequences.from_mysql(F.lit("incremental"), F.lit("u:1"), F.lit("1"), F.lit("0"), ["u"]),
        sequences.from_mysql(F.lit("false"), F.lit("other:1"), F.lit("1"), F.lit("0"), ["u"]),
        sequences.from_postgres(F.lit('["1","2"]'), F.lit(3)),
        sequences.from_ticdc(F.lit(5), F.lit("a"), "b"),
        sequences.from_source(F.create_map(F.lit("connector"), F.lit("oracle"))),
    ):
        with pytest.raises(Exception, match="USER_RAISED|sequence|source|cluster|snapshot|connector"):
            one.select(bad).collect()
    row = one.select(sequences.comparable(F.lit("a/1F")).alias("s"), sequences.is_valid(F.lit("1/2/3/4/5")).alias("v")).first()
    assert row["s"] == "000000000000000A/000000000000001F" and row["v"] is False


def test_form_body(spark):
    df = spark.createDataFrame([("a b&c", ["x", "ü=1"], None, "")], "name string, tags array<string>, gone string, empty string")
    assert df.select(form_body(df, ["name", "tags", "gone", "empty"]).alias("b")).first()["b"] == "name=a+b%26c&tags=x&tags=%C3%BC%3D1&empty="
    with pytest.raises(ValueError):
        form_body(spark.range(1), ["id"])
    bad = spark.createDataFrame([(["x", None],)], "tags array<string>")
    with pytest.raises(Exception, match="null element"):
        bad.select(form_body(bad, ["tags"])).collect()


@given(st.text(alphabet="aé日😀", min_size=0, max_size=40), st.integers(min_value=16, max_value=60))
@settings(max_examples=25, deadline=None)
def test_truncation_is_utf8_safe(spark, text, limit):
    out = spark.createDataFrame([(text,)], "t string").select(formats.truncate_utf8(F.col("t"), limit).alias("t")).first()["t"]
    if len(text.encode()) <= limit:
        assert out == text
    else:
        assert len(out.encode()) <= limit and out.endswith(formats.TRUNCATION_MARK)
        kept = out[: -len(formats.TRUNCATION_MARK)]
        room = limit - len(formats.TRUNCATION_MARK)
        assert text.startswith(kept) and room - len(kept.encode()) < 4


def test_small_formats(spark):
    row = spark.range(1).select(formats.parse_uuid(F.lit("ABCDEF01-0000-4000-8000-0123456789AB")).alias("u"), formats.json_body(F.lit(None).cast("string").alias("x"), F.unhex(F.lit("00FF")).alias("b")).alias("j")).first()
    assert row["u"] == "abcdef01-0000-4000-8000-0123456789ab" and row["j"] == '{"x":null,"b":"AP8="}'
    with pytest.raises(Exception, match="not a UUID"):
        spark.range(1).select(formats.parse_uuid(F.lit("x"))).collect()
    assert formats.identifier("`a``b`") == "a`b" and formats.identifier("Ab", "postgres") == "ab" and formats.identifier('"Ab"', "postgres") == "Ab"


def test_retries():
    calls, waits = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise retry.RetryableError("UNAVAILABLE")
        return 7

    assert retry.with_retries(flaky, 5, 100, 1000, sleep=waits.append) == 7 and len(waits) == 2
    with pytest.raises(retry.RetryableError):
        retry.with_retries(lambda: (_ for _ in ()).throw(retry.RetryableError("INVALID_ARGUMENT")), 5, 1, 1, sleep=waits.append)
    assert all(75 <= retry.backoff_ms(1, 100, 1000, random.Random(i)) <= 125 for i in range(20))
