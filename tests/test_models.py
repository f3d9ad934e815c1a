"""Rules of models against the same patterns in Python, one model after another."""

import re

from pyspark.sql import functions as F

from quarrymill.functions import models as M

CARS = [
    ("FERRARI", "F12 berlinetta", 2013), ("ferrari", "488 Pista", 2019), ("Ferrari", "Mondial", 1982), ("Ferrari", "Purosangue", 2023), ("Porsche", "911 (992) GT3 RS", 2021), ("Porsche", "718 Cayman GT4", 2020), ("Porsche", "Cayenne S", 2003), ("Porsche", "944", 1985),
    ("BMW", "M3 E92", 2009), ("BMW", "M5 E60 V10", 2006), ("BMW", "X3 M40i", 2020), ("BMW", "320d", 2012), ("BMW", "M2 CS", 2020), ("Mercedes-Benz", "C43", 2017), ("mercedes-benz", "SL 65 AMG Black Series", 2009), ("Mercedes-Benz", "C klasse", 1999), ("Mercedes-Benz", "300 SL", 1955),
    ("Audi", "A4 S line", 2015), ("Audi", "RS 6", 2015), ("Audi", "A3 R line", 2015), ("Volkswagen", "Golf R", 2015), ("Volkswagen", "Golf R-Line", 2015), ("Volkswagen", "Polo R Line", 2015), ("Hyundai", "i30 N", 2020), ("Hyundai", "i30 N Line", 2020), ("Toyota", "Supra", 1995), ("Mazda", "RX-7", 1992),
    ("Subaru", "Impreza", 1999), ("Lotus", "Elise", 1998), ("McLaren", "F1", 1994), ("Lamborghini", "Huracán EVO", 2020), ("Aston Martin", "V8 Vantage", 2007), ("Bugatti", "Type 35", 1926), ("Jaguar", "E-Type", 1961), ("Fiat", "Panda limited", None), ("Ford", "GT40 Le Mans", 1966), ("", "", None), (None, None, None), ("Zastava", "750", 1970),
]


def plain(make, model):
    by = {m.upper(): m for m in M.MAKES}
    mk, mo = by.get((make or "").strip().upper(), (make or "").strip()), (model or "").strip()
    has = lambda p: re.search(p, mo, re.IGNORECASE) is not None
    engine = next(((lay, cyl) for name, p, lay, cyl in M.ENGINES if name == mk and re.search(p, mo.lower())), (None, None))
    return mk, engine, has


def test_rules(spark):
    rows = spark.createDataFrame([(k, *c) for k, c in enumerate(CARS)], "k int, mk string, mo string, y int")
    got = {r.k: r for r in rows.select("k", M.model_rules(F.col("mk"), F.col("mo"), F.col("y")).alias("x")).select("k", "x.*").collect()}
    for k, (make, model, _) in enumerate(CARS):
        mk, engine, has = plain(make, model)
        r, fam = got[k], got[k].model_family
        assert (r.engine_layout, r.engine_cyl) == engine, (make, model)
        fast = mk in M.FAST_MAKES or (engine[1] or 0) >= 8 or has(M.FAST) or (mk == "Mercedes-Benz" and has(M.LETTER_AND_NUMBER)) or fam in M.FAST_FAMILIES.get(mk, []) or (mk == "BMW" and any(map(has, M.M_MODELS)))
        assert (r.is_performance, r.is_special_edition, r.is_competition, r.is_limited) == (fast, has(M.SPECIAL), has(M.RACING), has(M.LIMITED)), (make, model)
        assert r.is_icon == (fam in M.ICONS.get(mk, []))
    by = {c[:2]: got[k] for k, c in enumerate(CARS)}
    assert (by["ferrari", "488 Pista"].engine_layout, by["Porsche", "911 (992) GT3 RS"].generation_code, by["BMW", "M5 E60 V10"].engine_cyl) == ("V8", "992", 10)
    assert by["Porsche", "944"].is_performance and not by["BMW", "320d"].is_performance and by["Hyundai", "i30 N"].is_performance
    assert by["McLaren", "F1"].is_icon and by["Bugatti", "Type 35"].era == "prewar" and by["", ""].model_family is None
