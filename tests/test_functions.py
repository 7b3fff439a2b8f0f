from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal
from pathlib import PurePosixPath

import pytest
from pyspark.sql import functions as F

from sluice.functions.dates import coerce_date, http_last_modified, period_columns
from sluice.functions.names import ingest_name, path_stem, path_suffix, strip_extension
from sluice.functions.numbers import decimal_comma, to_decimal


def apply(spark, expression, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v STRING")
    return [row.r for row in df.select("i", expression(F.col("v")).alias("r")).orderBy("i").collect()]


def test_strip_extension(spark):
    assert apply(spark, strip_extension, ["a.b.zip", "noext", "x.zip", ""]) == ["a.b", "noext", "x", ""]


@pytest.mark.parametrize("path", ["d/cad_fi.csv", "cad_fi.csv", "noext", ".hidden", "d.x/noext", "a.b.c", "..x", "d/",
                                  "d.x/.hidden.txt"])
def test_stem_and_suffix_follow_path_rules(spark, path):
    expected = PurePosixPath(path)
    assert apply(spark, path_stem, [path]) == [expected.stem]
    assert apply(spark, path_suffix, [path]) == [expected.suffix]


def test_ingest_name(spark):
    moment = F.lit(datetime(2025, 3, 5, 9, 10, 11)).cast("timestamp_ntz")
    assert apply(spark, lambda c: ingest_name(c, moment), ["d/cad_fi.csv", "noext"]) == [
        "cad_fi_20250305091011.csv", "noext_20250305091011"]


def test_http_last_modified(spark):
    texts = ["Wed, 05 Mar 2025 09:10:11 GMT", "wed, 5 mar 2025 9:10:11 utc", "garbage", None,
             "Xyz, 05 Mar 2025 09:10:11 GMT", "Wed, 45 Mar 2025 09:10:11 GMT", "05 Mar 2025 09:10:11 GMT"]
    moment = datetime(2025, 3, 5, 9, 10, 11)
    naive = lambda c: F.convert_timezone(F.current_timezone(), F.lit("UTC"), http_last_modified(c).cast("timestamp_ntz"))
    assert apply(spark, naive, texts) == [moment, moment, None, None, None, None, None]


def test_http_last_modified_is_an_instant_in_any_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    seconds = lambda c: F.unix_seconds(http_last_modified(c))
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        assert apply(spark, seconds, ["Wed, 05 Mar 2025 09:10:11 GMT"]) == [1741165811]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_dates_that_are_none_become_null(spark):
    assert apply(spark, coerce_date, ["2025-01-31", "2025-13-01", "", None, "x"]) == [date(2025, 1, 31)] + [None] * 4
    assert apply(spark, lambda c: period_columns(c)["ano"], ["2025-01-31", "2025-13-01"]) == [2025, None]
    assert apply(spark, lambda c: period_columns(c)["mes"], ["2025-01-31", "2025-13-01"]) == [1, None]


def test_decimals(spark):
    texts = ["1234.565", "1234,56", "", "12345678901234567890", None, "-0.005"]
    assert apply(spark, to_decimal, texts) == [Decimal("1234.57"), None, None, None, None, Decimal("-0.01")]
    assert apply(spark, decimal_comma, texts) == [Decimal("1234.57"), Decimal("1234.56"), None, None, None,
                                                  Decimal("-0.01")]
    assert apply(spark, lambda c: to_decimal(c, scale=4), ["1.23456"]) == [Decimal("1.2346")]
