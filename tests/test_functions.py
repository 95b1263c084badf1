import datetime as dt
import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from spendecho import functions as fn
from spendecho.schemas import WHITESPACE


def values(spark, rows, schema, expr):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r.v for r in df.select("i", expr.alias("v")).orderBy("i").collect()]


@pytest.mark.parametrize("places", [2, 4, 6])
def test_round_half_away_from_zero(spark, places):
    xs = [1.5, -1.5, 0.0, 2.00005, 1.000049999, 20001 / 20000, -0.00001, 123456.789]
    got = values(spark, [(x,) for x in xs], "x double", fn.round_n(F.col("x"), places))
    scale = 10.0 ** places
    for x, v in zip(xs, got):
        expected = math.copysign(math.floor(abs(x) * scale + 0.5) / scale, x)
        assert v == pytest.approx(expected, abs=1e-12)
        assert not (v == 0 and math.copysign(1, v) < 0)


def test_ratio_by_zero_is_null(spark):
    got = values(spark, [(1, 0), (1, 4), (None, 2)], "a int, b int", fn.ratio(F.col("a"), F.col("b")))
    assert got == [None, 0.25, None]


def test_money_sum_is_exact_for_any_order(spark):
    random.seed(1)
    cents = [random.randint(-10**9, 10**9) for _ in range(2000)]
    df = spark.createDataFrame([(c,) for c in cents], "c long").select(
        (F.col("c").cast("decimal(18,0)") / 100).cast("decimal(18,2)").alias("m")
    )
    total = df.repartition(7).agg(fn.money_sum(F.col("m")).alias("t")).head().t
    assert int(total * 100) == sum(cents)


def test_exact_avg_ties(spark):
    xs = [0.83, 0.84] * 20 + [0.8325]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for parts in (1, 3, 8):
        got = df.repartition(parts).agg(fn.exact_avg(F.col("x"), 4).alias("a")).head().a
        assert got == 0.8349


def test_clamp(spark):
    got = values(
        spark, [("-1",), ("2",), ("0.4",), (None,), ("abc",), ("NaN",), (" 0.5 ",)], "x string",
        fn.clamp01(F.col("x")),
    )
    assert got == [0.0, 1.0, 0.4, 0.0, 0.0, 1.0, 0.5]


DATES = [
    "2024-03-05", "  2024-03-05 ", "2024-03-05 10:11:12", "03/05/2024", "3/5/24",
    "March 5, 2024", "2024.03.05", "5 Mar 2024", "2024-3-5", "march 5, 2024", "05 mar 2024",
    "2024-03-05  10:11:12", "\t2024-03-05",
]
NOT_DATES = ["", " ", "soon", None, "2024-13-05", "02/30/2024", "2024-03-05T10:11:12", "5Mar2024",
             "Mar 5, 2024", "2024-03-05 24:00:00"]


def test_dates(spark):
    got = values(spark, [(d,) for d in DATES + NOT_DATES], "d string", fn.parse_date_any(F.col("d")))
    assert got == [dt.date(2024, 3, 5)] * len(DATES) + [None] * len(NOT_DATES)


def test_two_digit_years(spark):
    got = values(
        spark, [("7/4/21",), ("7/4/68",), ("7/4/69",), ("2/29/96",), ("7/4/00",)], "d string",
        fn.parse_date_any(F.col("d")),
    )
    assert [d.year for d in got] == [2021, 2068, 1969, 1996, 2000]


def test_ratings(spark):
    cases = {
        "5": 5, "5/5": 5, "4.0": 4, "★★★☆☆": 3, "3 stars": 3, None: None, "good": None, "": None,
        "99999999999": None,
    }
    got = values(spark, [(k,) for k in cases], "r string", fn.parse_rating(F.col("r")))
    assert got == list(cases.values())


def test_channels(spark):
    cases = {
        "FB": "meta", " Insta ": "meta", "fb comment": "meta", "GMB": "google_ads",
        "Play Store": "google_ads", "TT comment": "tiktok", "Yotpo": "other", None: "other", "": "other",
    }
    got = values(spark, [(k,) for k in cases], "s string", fn.channel_of(F.col("s")))
    assert got == list(cases.values())


def test_sentiment_scores(spark):
    cases = {"positive": 1, "negative": -1, "neutral": 0, "mixed": 0, None: 0}
    got = values(spark, [(k,) for k in cases], "s string", fn.sentiment_score(F.col("s")))
    assert got == list(cases.values())


TEXTS = [
    "plain", "", None, "\t\n tab  ", " wide　", "\x1funit sep\x1c", "in  side",
    "  ", "é🙂 ", "​zero width stays",
]


def test_strip_and_hash(spark):
    rows = [(t, s) for t in TEXTS for s in ("FB", " FB ", None)]
    stripped = values(spark, rows, "t string, s string", fn.strip(F.col("t")))
    hashed = values(spark, rows, "t string, s string", fn.content_hash(F.col("t"), F.col("s")))
    for (t, s), got, digest in zip(rows, stripped, hashed):
        assert got == (t or "").strip()
        payload = f"{(t or '').strip()}||{(s or '').strip()}"
        assert digest == hashlib.sha256(payload.encode()).hexdigest()


def test_whitespace_is_all_of_it():
    assert set(WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_surrogate_key(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 2), "a"), (None, "a")], "d date, k string")
    got = [r.v for r in df.select(fn.surrogate_key("d", "k").alias("v")).collect()]
    assert got[0] == hashlib.md5(b"2024-01-02-a").hexdigest()
    assert got[1] == hashlib.md5(b"_dbt_utils_surrogate_key_null_-a").hexdigest()


def test_json_lists(spark):
    df = spark.createDataFrame([(["a", "é\"b"],), ([],), (None,)], "x array<string>")
    rows = df.select(fn.as_json_list(F.col("x")).alias("j")).select(
        "j", fn.from_json_list(F.col("j")).alias("back")
    ).collect()
    assert [r.j for r in rows] == ['["a","é\\"b"]', "[]", None]
    assert [r.back for r in rows] == [["a", 'é"b'], [], None]
