"""Answers that were worked out by hand, for the functions over names, places, pages and descriptions."""

import datetime

import pytest
from pyspark.sql import Column
from pyspark.sql import functions as F

from quarrymill.functions import adverts as V
from quarrymill.functions import features as X
from quarrymill.functions import models
from quarrymill.functions import numbers as N
from quarrymill.functions import text as T
from quarrymill.sources import files

CASES = {}


def answers(name, given, told, find):
    CASES[name] = given, told, find


def _make_and_model(said: Column) -> tuple[Column, Column]:
    return F.split_part(said, F.lit("|"), F.lit(1)), F.split_part(said, F.lit("|"), F.lit(2))


_ALIASES = {"mercedes-benz": "Mercedes-Benz", "mercedes": "Mercedes-Benz", "alfa romeo": "Alfa Romeo", "land rover": "Land Rover", "maserati": "Maserati", "audi": "Audi", "ferrari": "Ferrari"}
answers(
    "make_model_titles",
    ["Audi A4 Avant", "MaseratiLEVANTE 3.0 V6 275", "AUDI  A4", "Mercedes GLE 350", "Land Rover Defender", "", None, "Mercedes-Benz C 63 AMG", "Mercedes C 220 AMG Line", "alfa romeoX 4C", "zastava 750", "Mercedes-Benz"],
    [
        {"mk": "Audi", "mo": "A4 Avant"}, {"mk": "Maserati", "mo": "LEVANTE 3.0 V6 275"}, {"mk": "Audi", "mo": "A4"}, {"mk": "Mercedes-Benz", "mo": "GLE 350"}, {"mk": "Land Rover", "mo": "Defender"}, {"mk": "Inconnue", "mo": ""},
        {"mk": "Inconnue", "mo": ""}, {"mk": "Mercedes-AMG", "mo": "C 63 AMG"}, {"mk": "Mercedes-Benz", "mo": "C 220 AMG Line"}, {"mk": "Alfa", "mo": "romeoX 4C"}, {"mk": "Zastava", "mo": "750"}, {"mk": "Mercedes-Benz", "mo": ""},
    ],
    lambda s: {c: T.make_model(s, _ALIASES)[c] for c in ("mk", "mo")},
)

answers(
    "brand_keys",
    ["Mercedes AMG", "Alfa", "Aston  Martin V8", "Range Rover", "chevy", "VW", "Vauxhall", "Citroën", None],
    [{"k": x} for x in ("mercedes-benz", "alfa romeo", "aston martin", "land rover", "chevrolet", "volkswagen", "opel", "citroen", "")],
    lambda s: {"k": T.brand_key(s)},
)
answers("trimmed_models", ["911 | Top", "A4 // new", "M3 - full", "Golf; GTI", "| lead", "F40", ""], [{"mo": x} for x in ("911", "A4", "M3", "Golf", "lead", "F40", "")], lambda s: {"mo": T.trim_model(s)})
answers("deduped_words", ["911 Carrera 911 S", "Éclair eclair X", "M3 *** M3", "A B 2015 C D", "a"], [{"mo": x} for x in ("911 Carrera S", "Éclair X", "M3", "A B C D", "a")], lambda s: {"mo": T.dedupe_tokens(s)})
answers("clean_displays", ["911 / 912", "A/Abarth", "F12/tdf", "Z4"], [{"mo": x} for x in ("911", "Abarth", "F12/tdf", "Z4")], lambda s: {"mo": T.clean_display(s)})
answers(
    "localities",
    ["80331 Bayern - München", "10115  Berlin", "Berlin", "1234 x - y"],
    [{"plz": "80331", "region": "Bayern", "city": "München"}, {"plz": "10115", "region": "Berlin", "city": "Berlin"}, {"plz": None, "region": None, "city": None}, {"plz": None, "region": None, "city": None}],
    lambda s: {c: T.locality(s)[c] for c in ("plz", "region", "city")},
)
answers(
    "fuels_and_gears",
    [" Petrol", "gazole", "HYBRID", "electrique", "gpl", "pdk", "Mécanique", "wood", ""],
    [
        {"fuel": "Essence", "gear": "Petrol"}, {"fuel": "Diesel", "gear": "Gazole"}, {"fuel": "Hybride", "gear": "Hybrid"}, {"fuel": "Électrique", "gear": "Electrique"}, {"fuel": "GPL", "gear": "Gpl"},
        {"fuel": "Pdk", "gear": "Automatique"}, {"fuel": "Mécanique", "gear": "Manuelle"}, {"fuel": "Wood", "gear": "Wood"}, {"fuel": None, "gear": None},
    ],
    lambda s: {"fuel": T.fuel(s), "gear": T.gear(s)},
)
answers("parsed_ints", ["12 345 km", "7", "x", None, "1.234"], [{"n": x} for x in (12345, 7, None, None, 1234)], lambda s: {"n": N.parse_int(s)})

_FLAG = {"nl": "\U0001f1f3\U0001f1f1", "de": "\U0001f1e9\U0001f1ea", "at": "\U0001f1e6\U0001f1f9", "en": "\U0001f1ec\U0001f1e7"}
answers(
    "language_segments",
    ["the car and the engine with a new paint", f"intro {_FLAG['nl']} een auto {_FLAG['de']} ein Auto", f"{_FLAG['at']} und", f"{_FLAG['en']}  ", "", None, "zzz"],
    [{"lang": "en", "langs": "en"}, {"lang": "nl", "langs": "nl,de"}, {"lang": "de", "langs": "de"}, {"lang": "fr", "langs": "fr"}, {"lang": "fr", "langs": ""}, {"lang": "fr", "langs": ""}, {"lang": "fr", "langs": "fr"}],
    lambda s: {"lang": T.language(s), "langs": F.array_join(F.transform(T.language_segments(s), lambda x: x["lang"]), ",")},
)

_NEXT = '<script id="__NEXT_DATA__" type="x">{"props":{"pageProps":{"cars":[1]}}}</script>'
answers(
    "platforms",
    [
        _NEXT, _NEXT.replace("cars", "other"), '<script id="__NEXT_DATA__">{x</script>', '<meta name="generator" content="Symfio 2"><div class="vehicle-card">', '<meta name="generator" content="Drupal 9"><body class="x path-node">', '<div id="app" data-page="{}">',
        "<p class='rm-vehicle'>", '<i class="car-box"></i>' * 10, "<p>", "checking your browser, CloudFlare",
    ],
    [
        {"platform": "symfio_v2", "score": 0.95, "challenged": False}, {"platform": "symfio_v2", "score": 0.3, "challenged": False}, {"platform": "symfio_v2", "score": 0.2, "challenged": False}, {"platform": "symfio_v1", "score": 0.7, "challenged": False},
        {"platform": "drupal", "score": 0.8, "challenged": False}, {"platform": "inertia", "score": 0.85, "challenged": False}, {"platform": "rivamedia", "score": 0.3, "challenged": False}, {"platform": "generic_cards", "score": 0.5, "challenged": False},
        {"platform": "unknown", "score": 0.0, "challenged": False}, {"platform": "unknown", "score": 0.0, "challenged": True},
    ],
    lambda s: {"platform": T.platform(T.platform_scores(s)), "score": F.round(F.greatest(*T.platform_scores(s).values()), 6), "challenged": T.challenged(F.lit(503), s)},
)
answers(
    "detail_links",
    ['<a href="/car/1-b"><a href="/car/1-a"><a href="https://other.example/car/9"><a href="/contact.html">', "<a href='https://x.example/p.html'><a href='/a/12345/'><a href='rel/12345'>", "<a href='/x'>"],
    [{"links": "https://x.example/car/1-a|https://x.example/car/1-b"}, {"links": "https://x.example/a/12345/|https://x.example/p.html"}, {"links": ""}],
    lambda s: {"links": F.array_join(T.detail_links(s, F.lit("https://x.example/list?p=1")), "|")},
)

_CARD = '<div class="x card-1 y"><h2 class="t">{}</h2><ul id="spec"><li data-k="year">{}</li><li data-k="km"><b>{}</b> km</li><li class="price big"> {} €</li></ul></div>'


def _selected(s: Column) -> dict[str, Column]:
    field = lambda css: files.select_one(s, css)
    title = F.regexp_replace(field("div.card-1 h2.t"), r" (?:-|\||—) ", " ")
    made = T.make_model(title, _ALIASES)
    return {"mk": F.when(made["mk"] != T.UNKNOWN_MAKE, made["mk"]), "mo": made["mo"], "yr": N.parse_year(field("#spec li[data-k=year]")), "km": N.parse_int(field("li[data-k=km]")), "px": N.parse_int(field("ul > .price"))}


answers(
    "selector_fields",
    [_CARD.format("Audi - A4 Avant", 2012, "45 000", "12 500"), _CARD.format("Alfa Romeo | 4C", "MY 1999", "7", "900"), "<p class='t'>x</p>", '<div class="card-12"><h2 class="t">no</h2></div>', ""],
    [
        {"mk": "Audi", "mo": "A4 Avant", "yr": 2012, "km": 45000, "px": 12500}, {"mk": "Alfa Romeo", "mo": "4C", "yr": 1999, "km": 7, "px": 900}, {"mk": None, "mo": "", "yr": None, "km": None, "px": None},
        {"mk": None, "mo": "", "yr": None, "km": None, "px": None}, {"mk": None, "mo": "", "yr": None, "km": None, "px": None},
    ],
    _selected,
)

_FEATURES = [
    "Carnet rempli, fsh , 2 owners. Entretien chez Garage Bavaria, peinture refaite", "Sans carnet d'entretien. Dernière révision 06/2024 à 45 000 km", "Scheckheftgepflegt, Erstbesitzer, Originalzustand", "kein Scheckheft vorhanden, zonder service historie",
    "Garantie constructeur jusqu'au 15/03/2027, numbered, révision à faire", "", "libretto tagliandi completo, prima mano", "garage assez bien chauffé",
]
_TOLD = [
    {"carnet_present": True, "carnet_complet": True, "first_owner": False, "peinture_refaite": True, "revision_recente": False, "owners": 2, "garage": "garage bavaria", "doubtful": False, "until": None, "km": None},
    {"carnet_present": False, "carnet_complet": False, "first_owner": False, "peinture_refaite": False, "revision_recente": True, "owners": None, "garage": None, "doubtful": True, "until": None, "km": 45000},
    {"carnet_present": True, "carnet_complet": True, "first_owner": True, "peinture_refaite": False, "revision_recente": False, "owners": None, "garage": None, "doubtful": True, "until": None, "km": None},
    {"carnet_present": False, "carnet_complet": False, "first_owner": False, "peinture_refaite": False, "revision_recente": False, "owners": None, "garage": None, "doubtful": True, "until": None, "km": None},
    {"carnet_present": False, "carnet_complet": False, "first_owner": False, "peinture_refaite": False, "revision_recente": False, "owners": None, "garage": None, "doubtful": True, "until": "2027-03-15", "km": None},
    {"carnet_present": False, "carnet_complet": False, "first_owner": False, "peinture_refaite": False, "revision_recente": False, "owners": None, "garage": None, "doubtful": None, "until": None, "km": None},
    {"carnet_present": True, "carnet_complet": True, "first_owner": True, "peinture_refaite": False, "revision_recente": False, "owners": None, "garage": None, "doubtful": True, "until": None, "km": None},
    {"carnet_present": False, "carnet_complet": False, "first_owner": False, "peinture_refaite": False, "revision_recente": False, "owners": None, "garage": None, "doubtful": True, "until": None, "km": None},
]


def _all_features(s: Column) -> dict[str, Column]:
    f = X.extract(s, F.lit(""), F.lit("2025-01-10").cast("date"))
    names = {"owners": "nb_proprietaires", "garage": "suivi_garage_name", "doubtful": "suivi_douteux", "until": "garantie_fin_date", "km": "derniere_revision_km"}
    return {c: f[names.get(c, c)] for c in _TOLD[0]}


answers("features_all", _FEATURES, _TOLD, _all_features)
_V2 = ["carnet_present", "carnet_complet", "first_owner", "etat_origine", "garage_chauffe"]
answers(
    "features_v2",
    _FEATURES,
    [dict(zip(_V2, x, strict=True)) for x in ((False, True, False, False, False), (False, False, False, False, False), (True, True, True, True, False), (False, False, False, False, False), (False, False, False, False, False), (False, False, False, False, False), (True, True, True, False, False), (False, False, False, False, True))],
    lambda s: {c: X.pattern_flags(s)[c] for c in _V2},
)

answers(
    "track_models",
    ["Porsche|911 GT3 RS", "Porsche|911 Carrera", "BMW|M3 CSL", "BMW|635 CSi", "Ferrari|488 Pista", "Audi|TT RS", "Honda|Civic Type R"],
    [{"track": x} for x in (True, False, True, False, True, True, True)],
    lambda s: {"track": models.is_track(*_make_and_model(s))},
)
answers(
    "tuners",
    ["Alpina|B3", "Mercedes-Benz|C 63 AMG", "BMW|M3", "Audi|RS6", "Audi|S4", "Porsche|911 TechArt", "Ferrari|F430 Novitec", "Honda|Civic Mugen", "Fiat|Panda", "Fiat|500 Brabus", "Ford|amg", "Subaru|Impreza WRX STI"],
    [{"tuner": x} for x in ("Alpina", "AMG", "M", "RS", "S", "TechArt", "Novitec", "Mugen", None, "Brabus", None, "STI")],
    lambda s: {"tuner": V.tuner(*_make_and_model(s), F.lit(None).cast("string"), models.TUNER_MAKES, models.TUNERS)},
)
answers(
    "model_families",
    ["Porsche|911 (992) GT3|2021", "Porsche|cayenne S|2003", "Ferrari|812 Superfast|2018", "Ferrari|testarossa|1985", "Lamborghini|HURACAN evo|2020", "BMW|5 Series E39|1999", "Mercedes-Benz|C klasse W204|2008", "Mercedes-Benz|SLK 200|1998", "Fiat|Panda 4x4 x|1983", "Bugatti|Type 35|1926", "Fiat|-|0"],
    [
        {"family": "911", "generation": "992", "era": "modern"}, {"family": "Cayenne", "generation": None, "era": "youngtimer"}, {"family": "812", "generation": None, "era": "modern"}, {"family": "TESTAROSSA", "generation": None, "era": "classic"},
        {"family": "Huracan", "generation": None, "era": "modern"}, {"family": "5SERIES", "generation": "E39", "era": "youngtimer"}, {"family": "C-Class", "generation": "W204", "era": "modern"}, {"family": "SL", "generation": None, "era": "youngtimer"},
        {"family": "Panda 4x4", "generation": None, "era": "classic"}, {"family": "Type 35", "generation": None, "era": "prewar"}, {"family": None, "generation": None, "era": None},
    ],
    lambda s: {"family": models.family(*_make_and_model(s)), "generation": models.generation(_make_and_model(s)[1]), "era": models.era(F.split_part(s, F.lit("|"), F.lit(3)).cast("int"))},
)
answers(
    "rejections",
    ["Golf GTI old", "ebay Golf year of", "ebay Golf an 2000", "12 Golf GTI", "Dacia Logan 90000", "Golf GTI ok"],
    [{"reason": x} for x in (None, "year_default", None, "make_numeric", "price_luxury", None)],
    lambda s: {
        "reason": N.validate_reason(
            s, F.when(s.startswith("12"), "12").when(s.startswith("Dacia"), "Dacia").otherwise("Volkswagen"), s, F.when(s.contains("90000"), 120_000).otherwise(9_000), F.when(s.contains("90000"), 2015).otherwise(2000), F.lit(1000), F.lit(""), None, 2020,
            F.when(s.startswith("ebay"), "ebay-fr").otherwise("x"),
        )
    },
)


@pytest.mark.parametrize("name", CASES)
def test_answers(spark, name):
    given, told, find = CASES[name]
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(given)], "_k int, said string")
    found = find(F.col("said"))
    got = {r["_k"]: r for r in rows.select("_k", *[c.alias(n) for n, c in found.items()]).collect()}
    plain = lambda x: str(x) if isinstance(x, datetime.date) else x
    for k, want in enumerate(told):
        assert {c: plain(got[k][c]) for c in want} == want, (given[k], want)
