"""Scalar functions (C1-C21) and surrogate keys (C15) against hand-written expectations."""

import datetime as dt
import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.functions import keys as K
from wattlake.functions import text as tx


def one(spark, col, value, dtype=T.StringType()):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("v", dtype)]))
    return df.select(col.alias("o")).first()["o"]


def many(spark, fn, values, dtype=T.StringType()):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)],
                               T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", dtype)]))
    return [r["o"] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_key_text_matches_python_str(spark):
    values = [0.1, 1e-3, 1e-4, 1e7, 12345678.5, 1e15, -3.25, 5.0, 123456.78, 0.0, 496306.57, 3.0]
    got = many(spark, lambda c: K.key_text(c, T.DoubleType()), values, T.DoubleType())
    assert got == [str(v) for v in values]


def test_key_text_is_exact(spark):
    """The text of any double equals Python's, so different values never share an id."""
    import random
    import struct
    rng = random.Random(4)
    values = [1e-19, 2e-19, 0.0, -0.0, 0.00012345678901234567, 5e-324, 1.7976931348623157e308, 1e22, 1e16, 9999999999999998.0,
              123456789012345680.0, 1e-4, 9.999e-5, 0.1 + 0.2, 2 / 3, -1e-7, float("inf"), float("-inf"), 1e15, 1234567.0, 12345678.9, 2.0 ** -1060]
    values += [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(3000)]
    values += [rng.uniform(-1, 1) * 10 ** rng.randrange(-8, 19) for _ in range(2000)] + [round(rng.uniform(0, 1e6), 2) for _ in range(500)]
    values = [v for v in values if v == v]
    got = many(spark, lambda c: K.key_text(c, T.DoubleType()), values, T.DoubleType())
    bad = [(v, g) for v, g in zip(values, got) if g != str(v) and (2.3e-308 < abs(v) < 1e16 or float(g) != v)]
    assert len(set(got)) == len({repr(v) for v in values})
    assert not bad, (len(bad), bad[:5])


def test_key_text_null_and_nan(spark):
    got = many(spark, lambda c: K.key_text(c, T.DoubleType()), [None, float("nan")], T.DoubleType())
    assert got == ["nan", "nan"]


def test_surrogate_key_is_md5_of_joined_text(spark):
    got = one(spark, K.surrogate_key("cons_profile", K.key_text(F.lit(12.5), T.DoubleType()),
                                     K.key_text(F.lit(0.5), T.DoubleType())), None)
    assert got == hashlib.md5(b"cons_profile_12.5_0.5").hexdigest()


def test_time_id(spark):
    got = one(spark, K.time_id(F.lit(dt.date(2023, 3, 1)), F.lit("07:15:00")), None)
    assert got == hashlib.md5(b"2023-03-01T07:15:00").hexdigest()


def test_eu_date(spark):
    got = many(spark, tx.parse_eu_date, ["01.02.2023", "1.2.2023", "31.02.2023", "garbage", None, " 05.01.2024 "])
    assert got == [dt.date(2023, 2, 1), dt.date(2023, 2, 1), None, None, None, dt.date(2024, 1, 5)]


def test_short_date(spark):
    assert many(spark, tx.parse_short_date, ["01.03.23", "xx.03.23"]) == [dt.date(2023, 3, 1), None]


def test_iso_utc(spark):
    got = many(spark, lambda c: tx.ts_time(tx.parse_iso_utc(c)),
               ["2023-03-01T10:00:00Z", "2023-03-01T10:00:00+01:00", "2023-03-01T10:00:00-02:30", "bad"])
    assert got == ["10:00:00", "09:00:00", "12:30:00", None]


def test_french_date(spark):
    got = many(spark, tx.french_date, ["05 janv. 2023", "1 févr. 2023", "14 août 2023", "3 déc. 2023", "??", None])
    sentinel = dt.date(1900, 1, 1)
    assert got == [dt.date(2023, 1, 5), dt.date(2023, 2, 1), dt.date(2023, 8, 14), dt.date(2023, 12, 3),
                   sentinel, sentinel]


def test_eu_decimal(spark):
    assert many(spark, tx.eu_decimal, ["12,5", "0,25", "-3", "nan", "", "x", None]) == [
        12.5, 0.25, -3.0, None, None, None, None]


def test_strip_and_fill(spark):
    got = many(spark, lambda c: tx.fill_placeholder(tx.strip_quotes(c)), ['"R001"', '  "A" ', "", "nan", "None", None])
    assert got == ["R001", "A", "EMPTY", "EMPTY", "EMPTY", "EMPTY"]


def test_redact(spark):
    assert many(spark, tx.redact, ["Jane Doe", "", "  ", None]) == ["ANONYMIZED", "", "  ", None]


def py_normalize(t, bare=False):
    s = str(t).strip()
    parts = s.split(":")
    if len(parts) == 2:
        s = f"{s}:00"
    if bare and len(parts) == 1:
        s = f"{s.zfill(2)}:00:00"
    return s.zfill(8)


def test_normalize_time_cases(spark):
    vals = ["7:05", "07:05", "07:05:09", "7", "", "n/a", "12:30:00:00"]
    assert many(spark, tx.normalize_time, vals) == [py_normalize(v) for v in vals]
    assert many(spark, lambda c: tx.normalize_time(c, True), vals) == [py_normalize(v, True) for v in vals]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.from_regex(r"[0-9]{0,3}(:[0-9]{1,2}){0,2}", fullmatch=True), min_size=1, max_size=20))
def test_normalize_time_property(spark, values):
    assert many(spark, lambda c: tx.normalize_time(c, True), values) == [py_normalize(v, True) for v in values]


def test_hour_key_and_num(spark):
    vals = ["7:00", "13:45:00", "", "x:10"]
    assert many(spark, tx.hour_key, vals) == ["07", "13", "00", "0x"]
    assert many(spark, tx.hour_num, vals) == [7, 13, 0, 0]


def test_error_label_numeric(spark):
    got = many(spark, tx.error_label, [0.0, 0.0, 3.0, None], T.DoubleType())
    assert got == ["No Error", "No Error", "3.0", "No Error"]


def test_map_into_year(spark):
    got = many(spark, lambda c: tx.map_into_year(c, 2023), [dt.date(2024, 2, 29), dt.date(2024, 12, 31)], T.DateType())
    assert got == [dt.date(2023, 2, 28), dt.date(2023, 12, 31)]


def test_date_time_ts(spark):
    df = spark.createDataFrame([(dt.date(2023, 3, 1), "8"), (dt.date(2023, 3, 1), "bad")], "d date, t string")
    got = [r[0] for r in df.select(tx.date_time_ts("d", "t")).collect()]
    assert got == [dt.datetime(2023, 3, 1, 8, 0), None]
