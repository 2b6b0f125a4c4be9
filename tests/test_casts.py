import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pactlens.functions.casts import to_date_or_null, to_double_or_null

DATES = [
    "2024-01-15", "2024-1-5", " 2024-01-15 ", "\t2024-01-15\n", "2024-01-15T00:00:00.000", "2024-01-15T00:00:00Z",
    "2024-01-15 10:00:00", "2024-01-15 10:00", "2024-01-15 1:2:3", "2024-01-15 10:00:00.", "2024-01-15T10:00:00+05:00",
    "2024-01-15 24:00:00", "2024-01-15 25:00:00", "2024-01-15 23:59:60", "2024", "2024-01", "2024-01-15T", "2024-01-15 xx",
    "2024-01-15 10", "2024-01-15Z", "2024/01/15", "2024 01 15", "2024\\01\\15", "2024-01/15", "99-01-05", "12024-01-05",
    "2024-02-30", "2023-02-29", "15-01-2024", "20240115", "", "no-es-una-fecha", "2024-00-01", "+2024-01-01", "2024/1/5 10:00:00", None,
]
NUMBERS = [
    "5000000", "5e6", ".5", "5.", "+5", "-5", " 5 ", "\t5", "5_000_000", "5__0", "_5", "5_", "1_0.2_5", "1e1_0", "5000000d", "5000000f",
    "1D", "5L", "5,000,000", "$5", "0x10", "0x1p3", "", "abc", "NaN", "Infinity", "-inf", "inf", "1e400", "1e-400", "1e", "True", "+-5", "+-0", "-+5", "++5", None,
]


def spark_values(spark, texts, cast):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.select("i", cast(F.col("t")).cast("string").alias("v")).orderBy("i").select("v").collect()]


def duck_values(texts, kind):
    con = duckdb.connect()
    return [con.execute(f"SELECT TRY_CAST(? AS {kind})", [t]).fetchall()[0][0] for t in texts]


def test_dates_agree_with_try_cast(spark):
    want = [None if v is None else str(v) for v in duck_values(DATES, "DATE")]
    got = [None if v is None else v.lstrip("+") for v in spark_values(spark, DATES, to_date_or_null)]
    # Years beyond 9999 come back as text from DuckDB.
    assert dict(zip(DATES, got)) == dict(zip(DATES, want))


def test_numbers_agree_with_try_cast(spark):
    got = [None if v is None else float(v) for v in spark_values(spark, NUMBERS, to_double_or_null)]
    want = duck_values(NUMBERS, "DOUBLE")
    assert {t: repr(v) for t, v in zip(NUMBERS, got)} == {t: repr(v) for t, v in zip(NUMBERS, want)}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="0123456789-+.eE_dfx ", max_size=8), min_size=200, max_size=400))
def test_random_numbers_agree_with_try_cast(spark, texts):
    got = [None if v is None else float(v) for v in spark_values(spark, texts, to_double_or_null)]
    assert [repr(v) for v in got] == [repr(v) for v in duck_values(texts, "DOUBLE")]


@pytest.mark.parametrize("text", ["epoch", "infinity", "2024-01-15 (BC)"])
def test_special_dates_are_not_dates(spark, text):
    assert spark_values(spark, [text], to_date_or_null) == [None]
