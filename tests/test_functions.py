"""Golden vectors of the scalar functions (parity mode)."""

import math

import pytest
from pyspark.sql import functions as F

from souk.functions import (clip, first_truthy, parse_money, parse_percent, rating_trunc, safe_name, scaled_price,
                            sold_text_count, to_count, url_key, url_repair)


def col_values(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_parse_money(spark):
    inp = ["1,234,000", "1234đ", "  12 ", "1e5", ".5", "+7", "1.234.000 đ", "₫ 1,234", None, "nan", "", "1.5d",
           "1.5f", "0x10", "1_000", "inf", "Infinity"]
    exp = [1234000.0, 1234.0, 12.0, 100000.0, 0.5, 7.0] + [None] * 11
    assert col_values(spark, inp, parse_money) == exp


def test_parse_money_vnd_mode(spark):
    out = col_values(spark, ["1.234.000 đ", "₫ 1,234", "129.000₫"], lambda c: parse_money(c, mode="vnd"))
    assert out == [1234000.0, 1234.0, 129000.0]


def test_parse_percent_and_clip(spark):
    inp = [" 16% ", "-5%", "150%", "10% Off", None]
    assert col_values(spark, inp, parse_percent) == [16.0, -5.0, 150.0, None, None]
    assert col_values(spark, inp, lambda c: clip(parse_percent(c), 0.0, 100.0)) == [16.0, 0.0, 100.0, None, None]


def test_to_count(spark):
    assert col_values(spark, ["3.7", "x", None, "-2.9", "1e30"], to_count) == [3, 0, 0, -2, 0]


def test_sold_text_parity(spark):
    inp = ["312 sold", "Đã bán 5k+", "10K", "1.2k sold", "1,2k đã bán", "1.234 sold", "Đã bán", "", None]
    assert col_values(spark, inp, sold_text_count) == [312, 5000, 10000, 1000, 12000, 1, None, None, None]


def test_sold_text_decimal(spark):
    inp = ["1.2k sold", "312 sold", "Đã bán 5k+", "1,234 sold"]
    assert col_values(spark, inp, lambda c: sold_text_count(c, mode="decimal")) == [1200, 312, 5000, 1234]


def test_url_key_parity(spark):
    inp = ["https://www.lazada.vn//www.lazada.vn/products/x-i1.html", "//www.lazada.vn/products/a.html", "/p/q",
           "https://shopee.vn/product/1/2/", "http://www.x.vn/a//", "  https://x.vn/a ", ""]
    exp = ["https:/www.lazada.vn/www.lazada.vn/products/x-i1.html", "https://lazada.vn/www.lazada.vn/products/a.html",
           "https://lazada.vn/p/q", "https:/shopee.vn/product/1/2", "http:/www.x.vn/a", "https:/x.vn/a", ""]
    assert col_values(spark, inp, url_key) == exp


def test_url_key_fixed(spark):
    inp = ["https://www.lazada.vn//products/x.html", "//www.lazada.vn/products/a.html", "/p//q/",
           "http://x.vn/a//"]
    exp = ["https://lazada.vn/products/x.html", "https://lazada.vn/products/a.html", "https://lazada.vn/p/q",
           "https://x.vn/a"]
    assert col_values(spark, inp, lambda c: url_key(c, mode="fixed")) == exp


def test_url_repair_only(spark):
    assert col_values(spark, ["/p/1", "a//b"], url_repair) == ["https://www.lazada.vn/p/1", "a/b"]


def test_rating_trunc(spark):
    assert col_values(spark, [4.97, 4.3, 2.3, None], rating_trunc, "double") == [4.9, 4.3, 2.3, 0.0]


def test_scaled_price(spark):
    assert col_values(spark, [12345678, None, 0], scaled_price, "bigint") == [123.46, 0.0, 0.0]


def test_safe_name(spark):
    out = col_values(spark, ['a<b>c:d"e/f\\g|h?i*j', "x" * 60], safe_name)
    assert out == ["a_b_c_d_e_f_g_h_i_j", "x" * 50]


def test_first_truthy(spark):
    df = spark.createDataFrame([("", "5"), ("0", "7"), ("3", "9"), (None, None)], "a string, b string")
    out = [r[0] for r in df.select(first_truthy("a", "b")).collect()]
    assert out == ["5", "7", "3", None]


def test_clip_keeps_null(spark):
    assert col_values(spark, [None, 7.0, -1.0], lambda c: clip(c, 0.0, 5.0), "double") == [None, 5.0, 0.0]


@pytest.mark.parametrize("v", [0.125, 2.675])
def test_round_half_up_documented(spark, v):
    # Spark rounds half up on the decimal form (Python's round would give half-even)
    out = col_values(spark, [v], lambda c: F.round(c, 2), "double")[0]
    assert math.isclose(out, {0.125: 0.13, 2.675: 2.68}[v])


def test_unicode_white_space_and_false_text(spark):
    from souk.functions import first_truthy, parse_percent, strip_ws
    nbsp = "\u00a0"
    df = spark.createDataFrame([(f"10%{nbsp}", f"\u2003{nbsp}x y{nbsp}\n"), ("5%", "\x1f")], "p string, t string")
    assert [r[0] for r in df.select(parse_percent("p")).collect()] == [10.0, 5.0]
    assert [r[0] for r in df.select(strip_ws("t")).collect()] == ["x y", ""]
    v = spark.createDataFrame([(x,) for x in ("-", "+", ".", "e5", "0", "0.0", "-0", ".0", "0e5", "", None)], "a string")
    got = [r[0] for r in v.select(first_truthy("a", F.lit("next"))).collect()]
    assert got == ["-", "+", ".", "e5", "next", "next", "next", "next", "next", "next", "next"]
