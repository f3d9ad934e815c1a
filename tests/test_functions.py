"""Boundary cases of text and number expressions, on literal rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from quarrymill.functions import numbers as N
from quarrymill.functions import text as T


@pytest.fixture(scope="module")
def apply(spark):
    def run(values, make, kind="string"):
        rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")
        return [r.out for r in rows.select("k", make(F.col("v")).alias("out")).orderBy("k").collect()]

    return run


def test_normal_forms(apply):
    assert apply(["RS 6", "Rs6", "Q5", "E Tron", "e-tron", "Q4 e-tron", "TTS", None], T.normalize_model) == ["rs 6", "rs 6", "q 5", "e tron", "e tron", "q 4 e tron", "tts", None]
    assert apply(["RS 6", "320 d", "M 5 x", None], T.norm_tight) == ["rs6", "320d", "m5 x", ""]
    assert apply(["911T", "Málaga 2"], T.norm_split) == ["911 t", "malaga 2"]
    assert apply(["VW", "Mercedes-AMG", "Alfa", "Range Rover", "Citroën"], T.brand_key) == ["volkswagen", "mercedes-benz", "alfa romeo", "land rover", "citroen"]
    assert apply(["GLC 300 d 155 g/km", "E 9G-Tronic manual"], T.clean_tokens) == [["glc", "300", "d"], ["e"]]


def test_models(apply):
    assert apply(["911 2.7 S // 1974 // x", "A | b", "Werks-Turbo", "a  b", None], T.trim_model) == ["911 2.7 S", "A", "Werks-Turbo", "a b", None]
    assert apply(["GLC Coupe - GLC Coupé 300 d", "A *TAG x", "a 1999 b c"], T.dedupe_tokens) == ["GLC Coupe - 300 d", "A", "a b c"]
    assert apply(["Clio (2010)", "x"], T.remove_parens) == ["Clio", "x"]
    assert apply(["1 of 750", "Final Edition 200", "one of 15", "1 of 1999", "x"], T.limited_edition) == [750, 200, None, None, None]


def test_prices_and_numbers(apply):
    assert apply(["1.234,56", "1,234.56", "12.500", "12,5", "€ 12,500", "", "x", None, "0"], N.parse_price) == [1234.56, 1234.56, 12500.0, 12.5, 12500.0, None, None, None, None]
    assert apply(["km 12 500 km", "120.000 km", "no", "9999999 km"], N.extract_km) == [12500, 120000, 0, 0]
    assert apply(["Bj. 1987", "12019", "2039"], N.parse_year) == [1987, None, 2039]
    assert apply([12_500, 7_500, 2_500], lambda v: N.bucket(v, 5000), "int") == [10_000, 10_000, 0]
    assert apply(["31/02/2024", "5/7/2020", "03-2021", "x"], N.parse_date_fr) == [None, datetime.date(2020, 7, 5), datetime.date(2021, 3, 1), None]


def test_tiers(apply):
    tier = lambda y, p: apply([y], lambda v: N.listing_tier(v, F.lit(p).cast("long"), 2024), "int")[0]
    assert [tier(1999, 1), tier(2000, 99_999), tier(2010, 100_000), tier(2010, 500_000), tier(2010, 2_000_000), tier(2010, None)] == ["collector", "standard", "luxury", "supercar", "hypercar", "standard"]
    km = lambda upper: apply([None, 299, 300, 4999, 5000, 14_999, 15_000, 49_999, 99_999, 100_000, 200_000], lambda v: N.km_tier(v, F.lit("supercar" if upper else "luxury")), "int")
    assert km(True) == ["unknown", "zero_km", "as_new", "as_new", "low_km", "low_km", "moderate", "moderate", "well_used", "high_km", "very_high_km"]
    assert km(False)[1:5] == ["low_km"] * 4


def test_validation(spark):
    rows = spark.createDataFrame(
        [
            (1, None, "Ferrari", "Testarossa", None, 1991, "su richiesta", None), (2, None, "Ferrari", "Testarossa", None, 1991, "", "price_invalid"), (3, None, "A", "x", 900, 2000, "", "title_short"), (4, None, "911", "Porsche", 900, 2000, "", "make_numeric"),
            (5, None, "Ferrari", "F40", 499, 1991, "", "price_low"), (6, None, "Ferrari", "F40", 15_000_001, 1991, "", "price_cap"), (7, None, "Ferrari", "F40", 900, 1899, "", "year_old"), (8, None, "Ferrari", "F40", 900, 2026, "", "year_future"),
            (9, None, "Ferrari", "F40", 2999, 2022, "", "recent_cheap"), (10, None, "Ferrari", "F40", 2999, 2021, "", None), (11, None, "Nobody", "F40", 2999, 2001, "", "make_unknown"),
            (12, None, "Ford", "Focus", 600_000, 2015, "", "price_supercar"), (13, None, "Ford", "GT", 600_000, 2015, "", None), (14, None, "Ford", "Focus", 600_000, 1999, "", None), (15, None, "Audi", "R8", 100_000, 2015, "", None),
            (16, "Volant seul Ferrari", "Ferrari", "x", 600, 2001, "", "title_no_car"), (17, "Lot divers", "Lot", "x", 600, 2001, "", "make_none"), (18, "Ferrari 1/750", "Ferrari", "x", 600, 2001, "", None),
        ],
        "id int, title string, mk string, mo string, px int, yr int, de string, want string",
    )
    got = rows.select("id", "want", N.validate_reason(F.col("title"), F.col("mk"), F.col("mo"), F.col("px"), F.col("yr"), F.lit(None).cast("int"), F.col("de"), ["Ferrari", "A", "911", "Ford", "Audi"], 2024).alias("got")).collect()
    assert [(r.id, r.got) for r in got] == [(r.id, r.want) for r in got]


def test_price_proxy_and_moves(spark):
    rows = [(None, 10, 20, 30, 30), (12, 10, 20, None, 12), (5, 10, 20, None, 15), (5, None, None, None, 5), (5, 10, None, None, 10), (None, None, None, None, None), (0, None, None, 0, None)]
    df = spark.createDataFrame(rows, "bid long, lo long, hi long, sold long, want long")
    assert all(r.got == r.want for r in df.withColumn("got", N.price_proxy(F.col("bid"), F.col("lo"), F.col("hi"), F.col("sold"))).collect())
    df = spark.createDataFrame([(100.0, 101.0, False), (100.0, 102.0, True), (0.0, 5.0, True), (None, 5.0, True), (None, None, False)], "a double, b double, want boolean")
    assert all(r.got == r.want for r in df.withColumn("got", N.price_moved(F.col("a"), F.col("b"))).collect())


def test_auction_boundaries(spark):
    now = datetime.datetime(2024, 1, 1)
    hour = lambda h: now + datetime.timedelta(minutes=round(60 * h))
    rows = [(hour(72), None, None, "live", None), (hour(72.02), None, None, "upcoming", None), (hour(-1), None, None, "sold", None), (hour(-1), None, True, "sold", False), (hour(-1), None, False, "sold", True), (hour(5), hour(1), False, "upcoming", None), (None, None, None, "x", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, closes timestamp_ntz, starts timestamp_ntz, reserve boolean, want string, gone boolean")
    state = N.auction_state(F.col("closes"), F.col("starts"), F.lit("x"), F.col("reserve"), F.lit(now).cast("timestamp_ntz"))
    for r in df.select("*", *[c.alias(k) for k, c in state.items()]).collect():
        assert (r.new_status, r.withdrawn) == (r.want, r.gone), r.i
    hours = df.select("i", N.hours_to(F.col("closes"), F.lit("upcoming"), F.lit(now).cast("timestamp_ntz")).alias("h")).orderBy("i").collect()
    assert [r.h for r in hours][:3] == [72.0, 72.02, -1.0] and hours[-1].h == 999.0


def test_sold_verdict(apply):
    long = "<p>" + "word " * 400
    pages = ["<footer>all rights reserved</footer>", "<title>Sold</title>" + long, "<p>verkauft</p>", long + " sold here " + long, "x listing not found " + long, "<h1>Vendue</h1>" + long, "sold out"]
    assert apply(pages, T.sold_verdict) == [None, "sold", "verkauft", None, "listing not found", "vendue", None]


def test_places_and_languages(apply):
    assert apply([" UK ", "Österreich", "nowhere", None], T.country_iso) == ["gb", "at", None, None]
    assert apply(["Paris", "FR", "75008", "n/a", "", None, "Lyon 3"], T.is_city) == [True, False, False, False, False, False, True]
    got = apply(["80331 Bayern - München", "10115  Berlin", "x"], T.locality)
    assert [g and tuple(g) for g in got] == [("80331", "Bayern", "München"), ("10115", "Berlin", "Berlin"), None]
    assert apply(["der und die", "the and of", "zzz", None, "les des"], T.language_by_stop_words) == ["de", "en", "fr", "fr", "fr"]
    assert apply(["Petrol", "GAZOLE", "steam", None], T.fuel) == ["Essence", "Diesel", "Steam", None]
    assert apply(["https://www.a-b.de/car/1234567/x", "http://x.com"], T.slug) == ["a-b", "x"]
    assert apply(["https://a.de/12345/678901/x", "https://a.de/1"], T.listing_id) == ["678901", None]
    assert apply(["https://a.de/x.html", "https://a.de/", "https://a.de/a/b", "https://a.de/c1999"], T.url_shape) == ["car_page", "root", "car_page", "car_page"]


def test_fingerprint(spark):
    import hashlib

    row = spark.range(1).select(T.fingerprint(F.lit("Alfa-Romeo"), F.lit("GTV 6 - 2.5 Coupe"), F.lit(1985), F.lit(12_500)).alias("a"), T.fingerprint(F.lit("x"), F.lit(None).cast("string"), F.lit(1), F.lit(None).cast("int")).alias("b")).first()
    assert row.a == hashlib.md5(b"alfaromeogtv625198510000").hexdigest()[:12]
    assert row.b == hashlib.md5(b"x10").hexdigest()[:12]
