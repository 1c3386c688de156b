"""Scalar and geometry functions, one test per quirk decision."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from propspark.constants import RATE_BAND_ELSE, RATE_BANDS
from propspark.functions import geo as G
from propspark.functions import scalar as S


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def col_values(spark, expr, values, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r["r"] for r in df.select(expr.alias("r")).collect()]


def test_clean_numeric_strict(spark):
    got = col_values(spark, S.clean_numeric("v", "strict"),
                     ["12,5", "1 234", "250000", None, "abc", "1d", "0", "7."])
    assert got == [12.5, 1234.0, 250000.0, None, None, None, 0.0, 7.0]


def test_clean_numeric_substitute_reproduces_in_place_replacement(spark):
    # Q2: junk characters are replaced in place, NULL stays NULL.
    got = col_values(spark, S.clean_numeric("v", "substitute", "0.00001"), ["12,5", "80", None])
    assert got[0] == pytest.approx(120.000015)
    assert got[1:] == [80.0, None]


def test_parse_date_month_year(spark):
    got = col_values(spark, S.parse_date("v"), ["2021-03-15", "2021-02-30", "15/03/2021", None])
    assert got == [dt.date(2021, 3, 15), None, None, None]
    assert one(spark, S.month_key(F.to_date(F.lit("2021-03-15"))), "x") == "2021-03"
    assert one(spark, S.year_of(F.to_date(F.lit("2021-03-15"))), "x") == 2021


def test_french_month_labels(spark):
    labels = ["janv. 2015", "févr. 2015", "mars 2016", "avr. 2017", "mai 2018", "juin 2019",
              "juil. 2020", "août 2021", "sept. 2022", "oct. 2023", "nov. 2024", "déc. 2025"]
    got = col_values(spark, S.french_month_to_date("v"), labels)
    assert [(d.year, d.month, d.day) for d in got] == [
        (2015, 1, 1), (2015, 2, 1), (2016, 3, 1), (2017, 4, 1), (2018, 5, 1), (2019, 6, 1),
        (2020, 7, 1), (2021, 8, 1), (2022, 9, 1), (2023, 10, 1), (2024, 11, 1), (2025, 12, 1)]


def test_french_month_unknown_raises_or_null(spark):
    with pytest.raises(Exception):
        one(spark, S.french_month_to_date("v"), "foo 2015")
    assert one(spark, S.french_month_to_date("v", fail_on_unknown=False), "foo 2015") is None


def test_comma_decimal(spark):
    assert col_values(spark, S.comma_decimal("v"), ["2,49", "9", "-0,4", "x", None]) == [2.49, 9.0, -0.4, None, None]


def test_safe_ratio_division_by_zero_is_null(spark):
    # Q3: area 0 gives NULL, never inf.
    df = spark.createDataFrame([(100.0, 0.0), (100.0, 4.0), (None, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(S.safe_ratio("a", "b")).collect()] == [None, 25.0, None]


def test_sql_round_matches_sql_engines_on_binary_ties(spark):
    # 985.4 / 40 is 24.634999999999998 in binary; SQL engines give 24.64
    assert one(spark, S.sql_round(F.lit(985.4) / F.lit(40.0), 2), "x") == 24.64
    assert one(spark, S.sql_round(F.lit(2.5), 0), "x") == 3.0


def test_department_prefix(spark):
    got = col_values(spark, S.department_prefix("v"), ["75056", "2A004", "97105", "98735", None])
    assert got == ["75", "2A", "971", "987", None]


def test_missing_flag_counts_nan(spark):
    # Q1: NaN counts as missing and is filled with the radius.
    df = spark.createDataFrame([(float("nan"),), (None,), (12.5,)], "d double")
    rows = df.select(S.missing_flag("d").alias("f"), S.fill_missing("d", 500.0).alias("v")).collect()
    assert [(r.f, r.v) for r in rows] == [(1, 500.0), (1, 500.0), (0, 12.5)]


def test_households_rounding(spark):
    assert col_values(spark, S.households_from_population("v"), [14497, 310, 11], "v long") == [
        round(14497 / 2.2), round(310 / 2.2), 5]


def test_one_hot_and_log(spark):
    assert col_values(spark, S.one_hot("v", "Maison"), ["Maison", "Appartement", None]) == [1, 0, None]
    assert one(spark, S.natural_log("v"), 100.0, "v double") == pytest.approx(math.log(100))


def test_rate_band_null_falls_in_last_band(spark):
    got = col_values(spark, S.band("v", RATE_BANDS, RATE_BAND_ELSE), [1.5, 2.0, 3.99, 4.0, None], "v double")
    assert got == ["Taux < 2%", "Taux 2-3%", "Taux 3-4%", RATE_BAND_ELSE, RATE_BAND_ELSE]


def test_truthy_int(spark):
    assert col_values(spark, S.truthy_int("v"), [True, False, None], "v boolean") == [1, 0, 0]
    assert col_values(spark, S.truthy_int("v"), ["oui", "", None, "0", "false"]) == [1, 0, 0, 1, 1]
    assert col_values(spark, S.truthy_int("v"), [0.0, 2.5, None], "v double") == [0, 1, 0]


def test_tolerant_float(spark):
    assert col_values(spark, S.tolerant_float("v"), ["120.5", "", "n/a", None, "0"]) == [120.5, None, None, None, 0.0]


def test_polymorphic_price(spark):
    vals = ["250000", '{"value": 180000, "commission": 9000}', '{"value": 0, "commission": 1200}', None,
            '{"commission": 15}']
    assert col_values(spark, S.polymorphic_price("v"), vals) == [250000.0, 180000.0, 1200.0, None, 15.0]
    assert col_values(spark, S.polymorphic_value("v"), ["800", '{"value": 5000}', None]) == [800.0, 5000.0, None]


def test_image_path(spark):
    df = spark.createDataFrame([("AB12", 1), ("AB12", 3)], "id string, n int")
    assert [r[0] for r in df.select(S.image_path("id", "n")).collect()] == ["AB12/image_1.jpg", "AB12/image_3.jpg"]


def test_lambert93_anchors(spark):
    df = spark.createDataFrame([(3.0, 46.5), (2.3522, 48.8566)], "lon double, lat double")
    rows = df.select(G.lambert93_x("lon", "lat").alias("x"), G.lambert93_y("lon", "lat").alias("y")).collect()
    assert rows[0].x == pytest.approx(700000.0, abs=1e-6) and rows[0].y == pytest.approx(6600000.0, abs=1e-6)
    assert rows[1].x == pytest.approx(652469.0227, abs=1e-3) and rows[1].y == pytest.approx(6862035.2594, abs=1e-3)


def test_ring_and_line_centroids(spark):
    ring = [(700000.0, 6600000.0), (700010.0, 6600000.0), (700010.0, 6600020.0), (700000.0, 6600020.0)]
    closed = ring + [ring[0]]
    line = [(0.0, 0.0), (10.0, 0.0)]
    df = spark.createDataFrame([(ring,), (closed,), (line,), ([(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)],)],
                               "pts array<struct<x:double,y:double>>")
    out = G.with_ring_centroid(df, "pts", "rc")
    out = G.with_line_centroid(out, "pts", "lc").collect()
    assert (out[0].rc.x, out[0].rc.y) == (pytest.approx(700005.0), pytest.approx(6600010.0))
    assert (out[1].rc.x, out[1].rc.y) == (pytest.approx(700005.0), pytest.approx(6600010.0))
    assert (out[2].lc.x, out[2].lc.y) == (pytest.approx(5.0), pytest.approx(0.0))
    assert out[3].rc is None  # collinear ring: zero area
