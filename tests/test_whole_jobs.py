"""Queries over names, places, pages and descriptions do whole jobs: the answers that each must have among its rows."""

import pytest

from quarrymill.plans import columns

DATA = "/root/testdata/sf0.001"
CASES = {
    "make_model_titles": (["mk"], {(x,) for x in ("NATION_1", "Audi", "Maserati", "Mercedes-Benz", "Land Rover", "Inconnue", "Mercedes-AMG", "Alfa", "Alfa Romeo", "Zastava")}),
    "brand_keys": (["k"], {(x,) for x in ("mercedes-benz", "alfa romeo", "aston martin", "land rover", "chevrolet", "volkswagen", "opel", "")}),
    "trimmed_models": (["mo"], {("",), ("|",), (None,)}),
    "fuels_and_gears": (["fuel", "gear"], {("Hybride", "Hybrid"), ("Électrique", "Electrique"), ("GPL", "Gpl"), ("Essence", "Petrol"), ("Pdk", "Automatique"), ("Mécanique", "Manuelle"), (None, None)}),
    "language_segments": (["kind", "lang", "langs"], {("text", "en", "en"), ("text", "de", "de"), ("text", "nl", "nl,de"), ("text", "en", "en,fr"), ("mark", "nl", "nl,de"), ("mark", "fr", ""), ("mark", "fr", "fr")}),
    "platforms": (
        ["platform", "score", "challenged"],
        {("symfio_v2", 0.95, False), ("symfio_v2", 0.3, False), ("symfio_v2", 0.2, False), ("symfio_v1", 0.7, False), ("drupal", 0.8, False), ("inertia", 0.85, False), ("rivamedia", 0.3, False), ("generic_cards", 0.5, False), ("unknown", 0.0, False), ("unknown", 0.0, True)},
    ),
    "selector_fields": (["mk"], {("Audi",), ("Alfa Romeo",), ("Mercedes-Benz",), (None,)}),
}


@pytest.mark.parametrize("name", CASES)
def test_has_all_answers(spark, name):
    cols, wanted = CASES[name]
    got = {tuple(r) for r in columns.QUERIES[name](spark, DATA).select(*cols).distinct().collect()}
    assert wanted <= got
