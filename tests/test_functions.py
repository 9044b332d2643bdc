from __future__ import annotations

from decimal import Decimal as D

import pytest
from conftest import as_dicts
from pyspark.sql import functions as F

from layerlake.functions import columns as cols
from layerlake.functions import fixed_values as fixed
from layerlake.functions import money


def values(spark, kind, *vals):
    return spark.createDataFrame([(v,) for v in vals], f"x {kind}")


def one(df, col):
    return [r[0] for r in df.select(col).collect()]


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        ("Dra. ana LIMA", "Ana Lima"),
        ("Dr X", "Dr X"),
        ("  Sr.  joão DA silva ", "João Da Silva"),
        ("Srta. Bia", "Bia"),
        ("Sr. ", "Sr."),
        ("Drake Souza", "Drake Souza"),
        (None, None),
    ],
)
def test_person_names(spark, raw, clean):
    assert one(values(spark, "string", raw), cols.clean_person_name("x")) == [clean]


def test_title_needs_dot_and_space(spark):
    df = values(spark, "string", "Sra. A", "Sra.A", "Sra A", "sra. a")
    assert one(df, cols.has_title("x")) == [True, False, False, False]


def test_price_bands_at_the_limits(spark):
    df = values(spark, "decimal(10,2)", D("500.00"), D("500.01"), D("1000.00"), D("1000.01"), None)
    band = cols.banded("x", fixed.PRICE_BANDS, fixed.LOWEST_PRICE_BAND, inclusive=False)
    assert one(df, band) == ["BASICO", "MEDIO", "MEDIO", "PREMIUM", "BASICO"]


def test_segments_at_the_limits(spark):
    df = values(spark, "decimal(20,2)", D("21999.99"), D("22000.00"), D("16999.99"), D("17000.00"))
    band = cols.banded("x", fixed.SEGMENTS, fixed.LOWEST_SEGMENT, inclusive=True)
    assert one(df, band) == ["TOP_TIER", "VIP", "REGULAR", "TOP_TIER"]


def test_calendar_numbers_and_names(spark):
    df = spark.sql("SELECT timestamp_ntz'2026-01-11 23:59:59' AS ts UNION ALL SELECT timestamp_ntz'2025-12-13 00:00:00'")
    rows = as_dicts(cols.with_calendar(df, "ts"), "ts")
    assert [(r["weekday_no"], r["weekday"], r["sale_hour"]) for r in rows] == [(7, "Sábado", 0), (1, "Domingo", 23)]


def test_translation_of_unknown_value_is_null(spark):
    assert one(values(spark, "int", 1, 9), cols.translated("x", {1: "a"})) == ["a", None]


def test_day_parts(spark):
    df = values(spark, "int", 0, 5, 6, 11, 12, 17, 18, 23)
    assert one(df, cols.day_part("x")) == [
        "madrugada", "madrugada", "manha", "manha", "tarde", "tarde", "noite", "noite",
    ]


def test_price_position_order(spark):
    rows = [
        (D("11.00"), D("5.00"), D("8.00"), D("10.00"), fixed.DEARER_THAN_ALL),
        (D("4.00"), D("5.00"), D("8.00"), D("10.00"), fixed.CHEAPER_THAN_ALL),
        (D("10.00"), D("5.00"), D("8.00"), D("10.00"), fixed.ABOVE_MEAN),
        (D("5.00"), D("5.00"), D("8.00"), D("10.00"), fixed.BELOW_MEAN),
        (D("8.00"), D("5.00"), D("8.00"), D("10.00"), fixed.AT_MEAN),
        (D("8.00"), D("8.00"), D("8.00"), D("8.00"), fixed.AT_MEAN),
        (D("9.00"), D("8.00"), D("8.00"), D("8.00"), fixed.DEARER_THAN_ALL),
    ]
    kind = "o decimal(10,2), l decimal(10,2), m decimal(11,2), h decimal(10,2), want string"
    df = spark.createDataFrame(rows, kind).withColumn("got", cols.price_position("o", "l", "m", "h"))
    assert all(r["got"] == r["want"] for r in df.collect())


def test_threshold_is_decimal(spark):
    rows = [(D("60.00"), D("100.00")), (D("59.99"), D("100.00")), (D("1.00"), None)]
    df = spark.createDataFrame(rows, "p decimal(10,2), own decimal(10,2)")
    assert one(df, money.is_below_share("p", "own", D("0.6"))) == [False, True, False]


def test_price_cents_round_like_the_decimal_cast(spark):
    prices = [0.0, 0.01, 0.29, 1.005, 10.004999, 10.005, 64.79, 1286.09, 104887.46, 99999999.99, -3.335]
    df = values(spark, "double", *prices)
    cast = money.to_cents(money.amount("x"))
    assert one(df, money.price_cents("x")) == one(df, cast)


def test_line_revenue_overflow_is_an_error(spark):
    df = spark.createDataFrame([(10**6, D("1000.00"))], "q bigint, p decimal(10,2)")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|CANNOT_CHANGE_DECIMAL_PRECISION"):
        df.select(money.line_revenue("q", "p")).collect()


def test_mean_is_half_up_and_null_for_none(spark):
    df = spark.createDataFrame([(D("0.01"), 2), (D("10.00"), 3), (D("5.00"), 0)], "t decimal(20,2), n bigint")
    assert one(df, money.mean("t", "n")) == [D("0.01"), D("3.33"), None]


def test_percent_above(spark):
    rows = [(D("110.00"), D("100.00")), (D("95.00"), D("100.00")), (D("1.00"), D("0.00")), (D("1.00"), None)]
    df = spark.createDataFrame(rows, "v decimal(10,2), b decimal(10,2)")
    assert one(df, money.percent_above("v", "b")) == [D("10.00"), D("-5.00"), None, None]


def test_totals_use_the_cents_twin_and_agree(spark):
    df = spark.createDataFrame([(D("1.10"), 110), (D("2.25"), 225)], "x decimal(10,2), x_cents bigint")
    both = df.agg(money.total_of(df, "x").alias("a"), money.total("x").alias("b")).first()
    assert both["a"] == both["b"] == D("3.35")
    assert df.drop("x_cents").agg(money.total_of(df.drop("x_cents"), "x")).first()[0] == D("3.35")


def test_display_format(spark):
    df = values(spark, "decimal(20,2)", D("1234.56"), D("974077.28"), D("0.50"))
    assert one(df, money.format_brl("x")) == ["R$ 1.234,56", "R$ 974.077,28", "R$ 0,50"]


def test_undecided_rule_is_violated(spark):
    df = values(spark, "int", 1, -1, None)
    assert one(df, cols.violates(F.col("x") > 0)) == [False, True, True]


def test_missing_date_is_not_early(spark):
    df = spark.sql("SELECT timestamp'2025-01-01' AS a, timestamp'2025-01-02' AS b UNION ALL SELECT timestamp'2025-01-01', NULL")
    assert sorted(one(df, cols.is_earlier("a", "b"))) == [False, True]


def test_flatten_any_depth(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('nome', 'N', 'x', named_struct('y', 2)) AS regiao")
    flat = cols.flatten_structs(df)
    assert flat.columns == ["id", "regiao_nome", "regiao_x_y"]
    assert flat.first() == (1, "N", 2)


def test_conditional_set_and_rename(spark):
    df = spark.createDataFrame([("ecommerce", 1), ("loja_fisica", 2), (None, 3)], "canal_venda string, quantidade int")
    changed = cols.conditional_set(df, "canal_venda", "ECOMMERCE", F.col("canal_venda") == "ecommerce")
    assert [r[0] for r in changed.collect()] == ["ECOMMERCE", "loja_fisica", None]
    assert cols.rename_columns(df, fixed.PORTUGUESE_COLUMNS).columns == ["channel", "quantity"]


def test_cents_are_rounded(spark):
    df = spark.sql("SELECT * FROM VALUES (0.29D), (1.13D), (4.35D) AS t(x)")
    assert str(df.agg(money.total("x")).first()[0]) == "5.77"
    df = spark.sql("SELECT 1.9999BD AS x")
    assert str(df.agg(money.total("x")).first()[0]) == "2.00"


def test_titles_are_taken_literally(spark):
    df = spark.createDataFrame([("Dr (h.c.). Ana Lima",), ("Dr xhxcx. Ana Lima",)], "x string")
    assert one(df, cols.has_title("x", ["Dr (h.c.)"])) == [True, False]
