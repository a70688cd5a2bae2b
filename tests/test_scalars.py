import pytest
from pyspark.sql import functions as F

from orderlens.functions import scalars as s


def one(spark, column, frame=None):
    return (frame or spark.range(1)).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("x, d, want", [
    (3.14159, 2, 3.14), (3.14159, 3, 3.142), (3.14159, 0, 3.0), (99.999, 0, 100.0), (-2.5, 0, -2.0), (0.285, 2, 0.28)])
def test_round(spark, x, d, want):
    assert one(spark, s.round_half_up(F.lit(x), d)) == want


@pytest.mark.parametrize("part, total, want", [(1, 2, 50.0), (0, 10, 0.0), (1, 3, 33.33), (5, 0, 0.0)])
def test_percentage(spark, part, total, want):
    assert one(spark, s.percentage(F.lit(part), F.lit(total))) == want


@pytest.mark.parametrize("text, n, want", [
    ("long string here", 10, "long st..."), ("abcde", 4, "a..."), ("abcdef", 2, "ab"), ("abc", 0, ""),
    ("abc", 3, "abc"), ("abcd", 3, "abc"), ("abc", 10, "abc")])
def test_truncate(spark, text, n, want):
    assert one(spark, s.truncate(F.lit(text), n)) == want


def test_case(spark):
    assert one(spark, s.kebab_to_snake(F.lit("a-b-c"))) == "a_b_c"
    assert one(spark, s.snake_to_kebab(s.kebab_to_snake(F.lit("a-b-c")))) == "a-b-c"
    df = spark.createDataFrame([(1, 2)], "order_id int, unit_price int")
    assert s.kebab_columns(df).columns == ["order-id", "unit-price"]
    assert s.snake_columns(s.kebab_columns(df)).columns == df.columns


@pytest.mark.parametrize("text, want", [
    ("test@example.com", True), ("invalid", False), ("a@b", False), ("x a@b.c", True), ("a@b.c\n", False), (None, False)])
def test_email(spark, text, want):
    assert one(spark, s.valid_email(F.lit(text).cast("string"))) is want


def test_ranges(spark):
    assert [one(spark, s.within_range(F.lit(v), 1, 10)) for v in (0, 1, 5, 10, 11)] == [False, True, True, True, False]
    assert [one(spark, s.valid_positive(F.lit(v).cast("double"))) for v in (1.0, 0.0, -1.0, None, float("nan"))] == [
        True, False, False, False, False]


@pytest.mark.parametrize("text, want", [
    ("123", 123), ("-456", -456), ("+7", 7), ("123.45", None), (" 5", None), ("", None), ("abc", None), ("3000000000", None)])
def test_parse_int(spark, text, want):
    assert one(spark, s.try_parse_int(F.lit(text))) == want


@pytest.mark.parametrize("text, want", [
    ("100", 100.0), ("1.5e3", 1500.0), (".5", 0.5), ("5.", 5.0), ("", None), ("x", None), (" 2 ", 2.0)])
def test_parse_double(spark, text, want):
    assert one(spark, s.try_parse_double(F.lit(text))) == want


def test_maps(spark):
    m = F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(None).cast("int"), F.lit("e"), F.lit(42))
    assert one(spark, s.filter_null_values(m)) == {"a": 1, "e": 42}
    assert one(spark, s.safe_get(m, "a", 9)) == 1
    assert one(spark, s.safe_get(m, "b", 9)) is None
    assert one(spark, s.safe_get(m, "zz", 9)) == 9
    secret = F.create_map(F.lit("user"), F.lit("u"), F.lit("password"), F.lit("p"), F.lit("token"), F.lit("t"))
    assert one(spark, s.redact_map(secret, ["password", "token", "api-key"])) == {
        "user": "u", "password": "***REDACTED***", "token": "***REDACTED***"}
    row = s.redact_columns(spark.createDataFrame([("u", "p")], "user string, password string"), ["password", "x"]).first()
    assert tuple(row) == ("u", "***REDACTED***")


def test_time(spark):
    assert one(spark, s.iso_instant(F.lit(0).cast("bigint"))) == "1970-01-01T00:00:00Z"
    assert one(spark, s.iso_instant(F.lit(1704067207179))) == "2024-01-01T00:00:07.179Z"
    assert one(spark, s.iso_instant(F.lit(-1).cast("bigint"))) == "1969-12-31T23:59:59.999Z"
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert one(spark, s.epoch_millis(F.lit("2024-07-01 12:34:56.789").cast("timestamp_ntz"))) == 1719837296789
        assert one(spark, s.iso_instant(F.lit(1719837296789))) == "2024-07-01T12:34:56.789Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert one(spark, s.order_id_text()).startswith("ORDER-")


def test_money_sum_keeps_outsized_amounts(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,)], "x double")
    assert df.agg(s.money_sum("x").alias("x")).first()["x"] == 0.3
    huge = spark.createDataFrame([(1e300,), (5.0,)], "x double")
    assert huge.agg(s.money_sum("x").alias("x")).first()["x"] == 1e300
    assert df.filter("x > 9").agg(s.money_sum("x").alias("x")).first()["x"] == 0.0
