import ipaddress

import pytest
from pyspark.sql import functions as F

from millrace.functions import scalars

ADDRESSES = [
    "192.168.0.10", "0.0.0.0", "255.255.255.255", "999.1.1.1", "1.2.3", "1.2.3.4.5", "01.2.3.4", "1.2.3.256", "",
    "::", "::1", "1::", "2001:db8::7", "2001:db8:0:0:0:0:0:1", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7:8:9", "1:2:3:4:5:6:7",
    "1::2::3", ":::", ":1:2:3:4:5:6:7", "1:2:3:4:5:6:7:", "::ffff:192.168.0.1", "::ffff:999.1.1.1", "12345::", "g::1",
    "1:2:3:4:5:6:1.2.3.4", "fe80::1%eth0", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1::3:4:5:6:7:8", "1.2.3.4::",
]


def one(spark, column, kind="string", value=None):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("r")).first()["r"]


def test_addresses_agree_with_the_standard_library(spark):
    rows = spark.createDataFrame([(a,) for a in ADDRESSES], "x string").select("x", scalars.is_ip(F.col("x")).alias("r"))
    for address, found in rows.collect():
        try:
            ipaddress.ip_address(address)
            expected = True
        except ValueError:
            expected = False
        assert found == expected, address


@pytest.mark.parametrize(
    "text, expected",
    [("7301", 7301.0), (" -2.5 ", -2.5), ("4e2", 400.0), (".5", 0.5), ("seven", None), ("1d", None), ("", None), (None, None)],
)
def test_numbers(spark, text, expected):
    assert one(spark, scalars.to_number(F.col("x")), value=text) == expected


def test_days(spark):
    assert str(one(spark, scalars.to_day(F.col("x")), value="2019-02-28")) == "2019-02-28"
    assert one(spark, scalars.to_day(F.col("x")), value="soon") is None
    assert one(spark, scalars.to_day(F.col("x")), value="2019-02-29") is None


def test_missing_texts(spark):
    for text in ("", "NA", "null", " NaN "):
        assert one(spark, scalars.blank_to_null(F.col("x")), value=text) is None
    assert one(spark, scalars.blank_to_null(F.col("x")), value="Seoul") == "Seoul"


@pytest.mark.parametrize("value, expected", [(0, 1), (5, 5), (99, 10), (None, None)])
def test_clip_keeps_missing(spark, value, expected):
    assert one(spark, scalars.clip(F.col("x"), F.lit(1), F.lit(10)), "int", value) == expected


@pytest.mark.parametrize("rate, expected", [(0.9, "CRITICAL"), (0.30, "CRITICAL"), (0.2999, "HIGH"), (0.15, "HIGH"), (0.02, "MEDIUM"), (0.0, "MEDIUM")])
def test_severity(spark, rate, expected):
    assert one(spark, scalars.severity(F.col("x")), "double", rate) == expected


@pytest.mark.parametrize("ip, expected", [("192.168.0.10", "192.168.0.***"), ("::1", "masked"), ("-", "masked")])
def test_mask(spark, ip, expected):
    assert one(spark, scalars.mask_ip(F.col("x")), value=ip) == expected


def test_amount_rounds_halves_up_in_decimals(spark):
    amount = scalars.discounted_amount(F.lit(1), F.col("x"), F.lit(0.0))
    assert one(spark, amount, "double", 1.005) == 1.01
    assert one(spark, scalars.discounted_amount(F.lit(2), F.col("x"), F.lit(0.1)), "double", 1000.0) == 1800.0
    assert one(spark, amount, "double", None) is None


def test_flag_and_labels(spark):
    assert one(spark, scalars.high_price_flag(F.col("x")), "double", 100_000.0) == 0
    assert one(spark, scalars.high_price_flag(F.col("x")), "double", 100_000.5) == 1
    assert one(spark, scalars.label_of(F.col("x"), {0: "stayed", 1: "left"}), "int", 1) == "left"
    assert one(spark, scalars.label_of(F.col("x"), {0: "stayed", 1: "left"}), "int", 7) is None


def test_significance_is_strict(spark):
    assert one(spark, scalars.significance(F.col("x")), "double", 0.05) == "not significant"
    assert one(spark, scalars.significance(F.col("x")), "double", 0.0499) == "significant"


@pytest.mark.parametrize(
    "inputs, expected",
    [((100_000, 0.00004, 0.0), 4.0), ((10, 2.005, 0.12345), 17.57), ((3, 1e-12, 0.0), 0.0), ((10**15, 1e-12, 0.5), 500.0),
     ((1, 1e17, 0.0), 1e17), ((None, 1.0, 0.0), None), ((2, 0.105, 0.0), 0.21), ((1, 0.125, 0.0), 0.13)],
)
def test_amounts_keep_every_digit_until_the_end(spark, inputs, expected):
    row = spark.createDataFrame([inputs], "q bigint, p double, d double")
    assert row.select(scalars.discounted_amount(F.col("q"), F.col("p"), F.col("d"))).first()[0] == expected


@pytest.mark.parametrize(
    "values, expected",
    [([1e-15, 3e-15], 2e-15), ([1e17, 3e17], 2e17), ([0.1, 0.2, None], 0.15), ([None], None), ([1.5, 1e17, 1e-13], (1.5 + 1e17) / 3)],
)
def test_means_of_very_small_and_very_large_values(spark, values, expected):
    rows = spark.createDataFrame([(x,) for x in values], "x double")
    found = rows.agg(scalars.steady_mean(F.col("x"))).first()[0]
    assert found == (None if expected is None else pytest.approx(expected, rel=1e-12))
    assert rows.limit(0).agg(scalars.steady_mean(F.col("x"))).first()[0] is None


def test_sums_of_money_with_more_than_two_decimals(spark):
    rows = spark.createDataFrame([(0.00123,)] * 1000, "x double")
    assert float(rows.agg(scalars.exact_sum(F.col("x"))).first()[0]) == 1.23
