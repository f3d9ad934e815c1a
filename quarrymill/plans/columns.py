"""Functions over names, places, pages and descriptions, applied to the tables' own columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarrymill.functions import adverts as V
from quarrymill.functions import features as X
from quarrymill.functions import models
from quarrymill.functions import numbers as N
from quarrymill.functions import text as T
from quarrymill.plans import pages
from quarrymill.plans.listings import LISTING, listing, table
from quarrymill.sources.selectors import selected

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


C = F.col


def _pick(values: list[str | None], key: str = "p_partkey") -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (C(key) % len(values) + 1).cast("int"))


def _pick_sql(values: list[str | None], key: str = "p_partkey") -> str:
    listed = "[" + ", ".join("null" if v is None else "'" + v.replace("'", "''") + "'" for v in values) + "]"
    return f"{listed}[({key} % {len(values)} + 1)::int]"


def _filled(values: list[str | None], key: str = "p_partkey", name: str = "p_name") -> Column:
    """One of some texts by a row's number, with the row's name for {}."""
    return F.replace(_pick(values, key), F.lit("{}"), C(name))


def _filled_sql(values: list[str | None], key: str = "p_partkey", name: str = "p_name") -> str:
    return f"replace({_pick_sql(values, key)}, '{{}}', {name})"


# ---- makes, models, names ----


# Makes besides nations; titles of parts with their makes and models.
_MAKES = {"mercedes-benz": "Mercedes-Benz", "mercedes": "Mercedes-Benz", "alfa romeo": "Alfa Romeo", "land rover": "Land Rover", "maserati": "Maserati", "audi": "Audi", "ferrari": "Ferrari"}
_TITLES = [
    ("Audi {}", "Audi", "{}"), ("Maserati{} 3.0 V6", "Maserati", "{} 3.0 V6"), ("AUDI  {}", "Audi", "{}"), ("Mercedes GLE {}", "Mercedes-Benz", "GLE {}"), ("Land Rover {}", "Land Rover", "{}"), ("", T.UNKNOWN_MAKE, ""), (None, T.UNKNOWN_MAKE, ""),
    ("Mercedes-Benz C 63 AMG {}", "Mercedes-AMG", "C 63 AMG {}"), ("Mercedes C 220 AMG Line {}", "Mercedes-Benz", "C 220 AMG Line {}"), ("alfa romeoX {}", "Alfa", "romeoX {}"), ("alfa romeo-{}", "Alfa Romeo", "{}"), ("zastava {}", "Zastava", "{}"), ("Mercedes-Benz", "Mercedes-Benz", ""),
]
_TITLED, _TITLE_MAKES, _TITLE_MODELS = map(list, zip(*_TITLES, strict=True))


@query(
    "select 'customer' as kind, c_custkey as key, n_name as mk, c_name || case when c_custkey % 3 = 0 then ' ' || c_mktsegment else '' end as mo from customer join nation on c_nationkey = n_nationkey"
    f" union all select 'part', p_partkey, {_pick_sql(_TITLE_MAKES)}, {_filled_sql(_TITLE_MODELS)} from part"
)
def make_model_titles(spark, d):
    """Customers under nations, of which there are 25, in any case and with more spaces; parts under makes of one word and of
    several, glued to the model, unknown or missing."""
    nation = table(spark, d, "nation").select("n_nationkey", "n_name")
    makes = _MAKES | {r.n_name.lower(): r.n_name for r in nation.collect()}
    rows = table(spark, d, "customer").join(F.broadcast(nation), C("c_nationkey") == C("n_nationkey"))
    title = _text(F.when(C("c_custkey") % 2 == 0, F.lower("n_name")).otherwise(C("n_name")), "  ", C("c_name"), F.when(C("c_custkey") % 3 == 0, F.concat(F.lit(" "), "c_mktsegment")).otherwise(""))
    of_customers = rows.select(F.lit("customer").alias("kind"), C("c_custkey").alias("key"), title.alias("title"))
    of_parts = table(spark, d, "part").select(F.lit("part").alias("kind"), C("p_partkey").alias("key"), _filled(_TITLED).alias("title"))
    return of_customers.union(of_parts).select("kind", "key", T.make_model(C("title"), makes).alias("x")).select("kind", "key", "x.mk", "x.mo")


# Makes as parts have them, with their keys.
_BRANDS = [
    ("Mercedes AMG {}", "mercedes-benz"), ("Alfa", "alfa romeo"), ("Aston  Martin {}", "aston martin"), ("Range Rover {}", "land rover"), ("LandRover {}", "land rover"), ("LAND ROVER {}", "land rover"), ("chevy", "chevrolet"), ("chevy {}", "chevy {}"),
    (" VW ", "volkswagen"), ("Volkswagen AG", "volkswagen"), ("VW {}", "vw {}"), ("Vauxhall {}", "opel"), ("Citroën {}", "citroen {}"), ("", ""), (None, ""),
]
_BRANDED, _BRAND_KEYS = map(list, zip(*_BRANDS, strict=True))


@query(
    "select 'supplier' as kind, s_suppkey as key, case s_suppkey % 6 when 0 then 'mercedes-benz' when 1 then 'alfa romeo' when 2 then 'land rover' when 3 then 'chevrolet' else 'citroen ' || lower(s_name) end as k from supplier"
    f" union all select 'part', p_partkey, {_filled_sql(_BRAND_KEYS, name='lower(p_name)')} from part"
)
def brand_keys(spark, d):
    k = C("s_suppkey") % 6
    said = F.when(k == 0, _text(" MERCEDES ", C("s_name"))).when(k == 1, _text(C("s_name"), " Alfa")).when(k == 2, _text("Range Rover ", C("s_name"))).when(k == 3, _text("Chevrolet", C("s_name"))).otherwise(_text("Citroën ", C("s_name"), " "))
    of_suppliers = table(spark, d, "supplier").select(F.lit("supplier").alias("kind"), C("s_suppkey").alias("key"), said.alias("said"))
    of_parts = table(spark, d, "part").select(F.lit("part").alias("kind"), C("p_partkey").alias("key"), _filled(_BRANDED).alias("said"))
    return of_suppliers.union(of_parts).select("kind", "key", T.brand_key(C("said")).alias("k"))


# Forms of names, {} the part's name and [] what is cut off, with what is left.
_TRIMMED = [("{} | []", "{}"), ("{} // []", "{}"), ("{} - []", "{}"), ("{}; []", "{}"), ("{} – []", "{}"), ("{} — []", "{}"), ("{} / []", "{}"), ("{}%20[]", "{}"), ("{}|[]", "{}"), ("| {}", "{}"), ("{}", "{}"), ("", ""), ("|", "|"), (None, None)]


@query(f"select p_partkey, {_filled_sql([mo for _, mo in _TRIMMED])} as mo from part")
def trimmed_models(spark, d):
    said = F.replace(_filled([said for said, _ in _TRIMMED]), F.lit("[]"), _text(C("p_type"), " // ", C("p_brand")))
    return table(spark, d, "part").select("p_partkey", T.trim_model(said).alias("mo"))


@query("select p_partkey, p_name || case when list_contains(string_split(p_name, ' '), lower(p_type)) then '' else ' ' || p_type end || ' ' || p_brand as mo from part")
def deduped_words(spark, d):
    """Words of a name that come again, in capitals, go; so does what stands after a star."""
    return table(spark, d, "part").select("p_partkey", T.dedupe_tokens(_text(C("p_name"), " ", F.upper("p_name"), " ", C("p_type"), " ", F.lower("p_type"), " ", C("p_brand"), " * seen")).alias("mo"))


@query("select p_partkey, case p_size % 3 when 0 then p_name when 1 then p_type || lower(p_type) else p_name || '/' || p_size::varchar end as mo from part")
def clean_displays(spark, d):
    k, size = C("p_size") % 3, C("p_size")
    said = F.when(k == 0, _text(C("p_name"), " / ", C("p_type"))).when(k == 1, _text(C("p_type"), "/", C("p_type"), F.lower("p_type"))).otherwise(_text(C("p_name"), "/", size))
    return table(spark, d, "part").select("p_partkey", T.clean_display(said).alias("mo"))


@query("select c_custkey, case when c_custkey % 4 <> 3 then lpad((c_custkey % 100000)::varchar, 5, '0') end as plz, case when c_custkey % 4 <> 3 then n_name end as region, case c_custkey % 4 when 3 then null when 2 then n_name else c_mktsegment end as city from customer join nation on c_nationkey = n_nationkey")
def localities(spark, d):
    rows = table(spark, d, "customer").join(F.broadcast(table(spark, d, "nation")), C("c_nationkey") == C("n_nationkey"))
    code, k = F.lpad((C("c_custkey") % 100_000).cast("string"), 5, "0"), C("c_custkey") % 4
    said = F.when(k == 3, _text(C("n_name"), " - ", C("c_mktsegment"))).when(k == 2, _text(code, "  ", C("n_name"))).otherwise(_text(code, " ", C("n_name"), " - ", C("c_mktsegment")))
    return rows.select("c_custkey", T.locality(said).alias("x")).select("c_custkey", "x.plz", "x.region", "x.city")


# Fuels and gears as parts have them, {} the part's name.
_SAID_GEARS = [f" {w.upper()}" if k % 2 else f"{w} " for k, w in enumerate(w for names in (T.FUELS | T.GEARS).values() for w in names)] + ["{}", "{} diesel", "", " ", None]


def _mapped_sql(names: dict[str, list[str]], said: str) -> str:
    listed = lambda words: ", ".join(f"'{w}'" for w in words)
    return "case " + " ".join(f"when lower(trim({said})) in ({listed(words)}) then '{name}'" for name, words in names.items()) + f" else nullif(upper(left(trim({said}), 1)) || lower(substr(trim({said}), 2)), '') end"


@query(
    "select 'customer' as kind, c_custkey as key, case c_custkey % 5 when 0 then 'Essence' when 1 then 'Diesel' else upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) end as fuel, case c_custkey % 5 when 0 then 'Automatique' when 2 then 'Manuelle' else upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) end as gear from customer"
    f" union all select 'part', p_partkey, {_mapped_sql(T.FUELS, 'said')}, {_mapped_sql(T.GEARS, 'said')} from (select p_partkey, {_filled_sql(_SAID_GEARS)} as said from part)"
)
def fuels_and_gears(spark, d):
    """Customers with some fuels and gears, and parts with all words for them and with others."""
    k, said = C("c_custkey") % 5, _filled(_SAID_GEARS)
    of_customers = table(spark, d, "customer").select(F.lit("customer").alias("kind"), C("c_custkey").alias("key"), F.when(k == 0, " Petrol").when(k == 1, "gazole").otherwise(C("c_mktsegment")).alias("f"), F.when(k == 0, "PDK ").when(k == 2, "mécanique").otherwise(C("c_mktsegment")).alias("g"))
    of_parts = table(spark, d, "part").select(F.lit("part").alias("kind"), C("p_partkey").alias("key"), said.alias("f"), said.alias("g"))
    return of_customers.union(of_parts).select("kind", "key", T.fuel(C("f")).alias("fuel"), T.gear(C("g")).alias("gear"))


@query("select o_orderkey, case when o_orderkey % 7 = 0 then null else floor(o_totalprice)::bigint end as n from orders")
def parsed_ints(spark, d):
    whole = F.floor("o_totalprice").cast("long")
    said = F.when(C("o_orderkey") % 7 == 0, C("o_orderstatus")).when(C("o_orderkey") % 7 < 4, F.replace(F.format_number(whole, 0), F.lit(","), F.lit(" "))).otherwise(_text(F.format_number(whole, 0), " €"))
    return table(spark, d, "orders").select("o_orderkey", N.parse_int(said).alias("n"))


# Forms of texts with flags, {} the document's whole text, and of short ones, {} its number and [] its source.
_FLAGGED = ["{}", "intro 🇳🇱 {} 🇩🇪 {}", "🇦🇹{}", "{} 🇬🇧  ", "🇬🇧 {}🇮🇹🇫🇷 {} 🇺🇸"]
_MARKED = ["intro 🇳🇱 {} 🇩🇪 []x", "🇦🇹[]x", "zz{}", "", None, "🇬🇧  "]


def _segments_sql() -> str:
    flag = "(?:" + "|".join(T.FLAG_LANGUAGES) + ")"
    told = "case f[i] " + " ".join(f"when '{x}' then '{lang}'" for x, lang in T.FLAG_LANGUAGES.items()) + " end"
    count = {lang: "len([x for x in w if x in (" + ", ".join(f"'{x}'" for x in words) + ")])" for lang, words in T.STOP_WORDS.items()}
    most = "greatest(" + ", ".join(f"{lang}_n" for lang in count) + ")"
    return (
        f"with s as (select doc_id, 'text' as kind, replace({_pick_sql(_FLAGGED, 'doc_id')}, '{{}}', coalesce(text, '')) as said from documents"
        f" union all select doc_id, 'mark', replace(replace({_pick_sql(_MARKED, 'doc_id')}, '{{}}', doc_id::varchar), '[]', coalesce(source, 's')) from documents),"
        f" p as (select doc_id, kind, said, regexp_extract_all(said, '{flag}') as f, string_split_regex(said, '{flag}') as p, regexp_extract_all(lower(coalesce(said, '')), '[\\pL\\pM\\pN\\p{{Pc}}]+') as w from s),"
        f" c as (select doc_id, kind, said, [{told} for i in range(1, len(f) + 1) if regexp_matches(p[i + 1], '[^ \\t\\n\\x0b\\f\\r]')] as told, " + ", ".join(f"{n} as {lang}_n" for lang, n in count.items()) + " from p),"
        f" l as (select doc_id, kind, case when not regexp_matches(coalesce(said, ''), '[^ \\t\\n\\x0b\\f\\r]') then [] when len(told) > 0 then told when {most} = 0 then ['fr'] " + " ".join(f"when {lang}_n = {most} then ['{lang}']" for lang in count) + " end as langs from c)"
        " select doc_id, kind, coalesce(langs[1], 'fr') as lang, array_to_string(langs, ',') as langs from l"
    )


@query(_segments_sql())
def language_segments(spark, d):
    """Of each document its whole text, with and without flags, and a short one: parts after flags; what has no part of its own
    after a flag is in the language of its stop words, without any in the default language."""
    whole = F.replace(_pick(_FLAGGED, "doc_id"), F.lit("{}"), F.coalesce("text", F.lit("")))
    short = F.replace(F.replace(_pick(_MARKED, "doc_id"), F.lit("{}"), C("doc_id").cast("string")), F.lit("[]"), F.coalesce("source", F.lit("s")))
    said = F.explode(F.array(F.struct(F.lit("text").alias("kind"), whole.alias("said")), F.struct(F.lit("mark").alias("kind"), short.alias("said"))))
    rows = table(spark, d, "documents").select("doc_id", said.alias("x")).select("doc_id", "x.kind", T.language_segments(C("x.said")).alias("parts"))
    return rows.select("doc_id", "kind", T.first_language(C("parts")).alias("lang"), F.array_join(C("parts.lang"), ",").alias("langs"))


# ---- pages ----


# What ways of building sites leave in pages, with the way and its score; checks for browsers come last.
_DATA = '<script id="__NEXT_DATA__" type="x">{}</script>'
_SYMFIO, _DRUPAL = '<meta name="generator" content="Symfio 2">', '<meta name="generator" content="Drupal 9"><body class="x path-node">'
_SIGNS = [
    (_DATA.format('{"props":{"pageProps":{"cars":[1]}}}'), "symfio_v2", 0.95), (_DATA.format('{"props":{"pageProps":{"vehicles":[]}}}'), "symfio_v2", 0.95), (_DATA.format('{"props":{"pageProps":{"other":[1]}}}'), "symfio_v2", 0.3), (_DATA.format('{"props":{}}'), "symfio_v2", 0.3), (_DATA.format("{x"), "symfio_v2", 0.2),
    (_SYMFIO, "symfio_v1", 0.5), (_SYMFIO + '<div class="vehicle-card">', "symfio_v1", 0.7), (_SYMFIO + '<script type="application/ld+json">{"@type": "Vehicle"}</script>', "symfio_v1", 0.8), (_DRUPAL, "drupal", 0.8), (_DRUPAL + '<img src="/sites/default/files/a.png">', "drupal", 1.0),
    ('<div id="app" data-page="{}">', "inertia", 0.85), ("""<i data-page='{"version"}'><script src="/inertia.js">""", "inertia", 0.95), ("<p class='rm-vehicle'>", "rivamedia", 0.3), ('<i class="car-box"></i>' * 10, "generic_cards", 0.5), ('<i class="car-box"></i>' * 30, "generic_cards", 0.7), ("<p>", "unknown", 0.0),
]
_CHECKS = ["checking your browser, CloudFlare", '<i id="cf-browser-verification">', "<script>__cf_chl_opt</script>"]
_SEEN, _WAYS = [s for s, _, _ in _SIGNS] + _CHECKS, [w for _, w, _ in _SIGNS] + ["unknown"] * len(_CHECKS)
_WAY_SCORES = [str(n) for _, _, n in _SIGNS] + ["0"] * len(_CHECKS)


@query(f"select page_id, {_pick_sql(_WAYS, 'page_id')} as platform, {_pick_sql(_WAY_SCORES, 'page_id')}::double as score, page_id % {len(_SEEN)} >= {len(_SIGNS)} as challenged from pages")
def platforms(spark, d):
    """Pages with what a way of building sites leaves in them."""
    page = F.concat(F.coalesce("html", F.lit("")), _pick(_SEEN, "page_id"))
    scores = T.platform_scores(page)
    return table(spark, d, "pages").select("page_id", T.platform(scores).alias("platform"), F.round(F.greatest(*scores.values()), 6).cast("double").alias("score"), T.challenged(F.lit(503), page).alias("challenged"))


@query("select page_id, regexp_extract(url, '^[A-Za-z]+://[^/?#]*') || '/car/' || page_id::varchar || '-a' || '|' || regexp_extract(url, '^[A-Za-z]+://[^/?#]*') || '/car/' || page_id::varchar || '-b' as links from pages")
def detail_links(spark, d):
    """Links to listings among a page's own, in their order, without those of other hosts and of contact pages."""
    n = C("page_id").cast("string")
    page = _text(C("html"), '<a href="/car/', n, '-b"><a href="/car/', n, '-a"><a href="https://other.invalid/car/9"><a href="/contact.html"><a href="/car/', n, '-b">')
    return table(spark, d, "pages").select("page_id", F.array_join(T.detail_links(page, C("url")), "|").alias("links"))


_CARD = {"title": "div.card-1 h2.t", "yr": "#spec li[data-k=year]", "km": "li[data-k=km]", "px": "ul > .price"}


# Titles of cards with their makes; {} the part's name.
_CARDS = [("Audi - {}", "Audi"), ("Alfa Romeo | {}", "Alfa Romeo"), ("AUDI — {}", "Audi"), ("mercedes-benz {}", "Mercedes-Benz")]


@query(
    f"select p_partkey, case when k < 4 then {_pick_sql([mk for _, mk in _CARDS])} end as mk, case when k < 4 then p_name else '' end as mo, case when k < 4 then 1950 + p_size end as yr, case when k < 4 then p_partkey end as km, case when k < 4 then round(p_retailprice)::bigint end as px"
    " from (select *, p_partkey % 8 as k from part)"
)
def selector_fields(spark, d):
    """Cards of parts, read by selectors; pages without a card, with another and without anything."""
    k, price = C("p_partkey") % 8, F.round("p_retailprice").cast("long")
    spaced = lambda n: F.when(k % 2 == 0, n.cast("string")).otherwise(F.replace(F.format_number(n, 0), F.lit(","), F.lit(" ")))
    card = _text('<div class="x card-1 y"><h2 class="t">', _filled([said for said, _ in _CARDS]), '</h2><ul id="spec"><li data-k="year">', F.when(k < 2, "MY ").otherwise(""), 1950 + C("p_size"), '</li><li data-k="km"><b>', spaced(C("p_partkey")), '</b> km</li><li class="price big"> ', spaced(price), " €</li></ul></div>")
    page = F.when(k < 4, card).when(k == 4, _text("<p class='t'>", C("p_name"), "</p>")).when(k == 5, _text('<div class="card-12"><h2 class="t">', C("p_name"), "</h2></div>")).when(k == 6, "")
    rows = table(spark, d, "part").select("p_partkey", selected(page, _CARD).alias("x"))
    field = lambda name: F.get(C("x")[name], F.lit(0))
    made = T.make_model(F.regexp_replace(field("title"), r" (?:-|\||—) ", " "), _MAKES)
    return rows.select("p_partkey", F.when(made["mk"] != T.UNKNOWN_MAKE, made["mk"]).alias("mk"), made["mo"].alias("mo"), N.parse_year(field("yr")).alias("yr"), N.parse_int(field("km")).alias("km"), N.parse_int(field("px")).alias("px"))


# ---- descriptions: documents, with a sentence by their number at the end ----

_SAID = ["full service history, première main", "sans carnet, garage chauffé, 3 owners", "carnet d'entretien, matching numbers, modified", "série limitée 1 of 500, centre agréé", "nothing more"]
_DESCRIBED = "d as (select doc_id, coalesce(text, '') || '. ' || [" + ", ".join("'" + s.replace("'", "''") + "'" for s in _SAID) + "][(doc_id % 5 + 1)::int] as text from documents), c as (select doc_id, text, lower(trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))) as t from d)"


def _described(spark, d):
    said = F.element_at(F.array(*[F.lit(s) for s in _SAID]), (C("doc_id") % 5 + 1).cast("int"))
    return table(spark, d, "documents").select("doc_id", F.concat(F.coalesce("text", F.lit("")), F.lit(". "), said).alias("text"))


def _words_sql(words: list[str]) -> str:
    return "(" + " or ".join("contains(t, '" + w.replace("'", "''") + "')" for w in words) + ")"


def _flag_sql(name: str) -> str:
    yes, no = X.FLAGS[name]
    found = _words_sql(yes) + (f" and not {_words_sql(no)}" if no else "")
    if name == "carnet_present":
        found = f"(({found}) or ({_flag_sql('carnet_complet')}))"
    if name == "serie_limitee":
        found = f"(({found}) or regexp_matches(t, '\\b1\\s+of\\s+500\\b'))"
    return f"({found})"


_OWNERS = "case " + " ".join(f"when {_words_sql(w)} then {k}" for k, w in X.OWNERS.items()) + " when regexp_matches(t, '3 owners') then 3 end"
_SOME = ["carnet_present", "carnet_complet", "first_owner", "garage_chauffe", "matching_numbers", "etat_origine", "serie_limitee", "suivi_constructeur", "peinture_refaite", "pneus_neufs", "revision_recente"]


@query(f"with {_DESCRIBED} select doc_id, " + ", ".join(f"{_flag_sql(n)} as {n}" for n in _SOME) + f", ({_OWNERS})::int as owners from c")
def features_v1(spark, d):
    rows = _described(spark, d).select("doc_id", X.clean(C("text")).alias("t"))
    flag = X.flags(C("t"))
    return rows.select("doc_id", *[flag[n].alias(n) for n in _SOME], X.owners(C("t")).alias("owners"))


def _score_sql() -> str:
    pt = lambda name, n: f"case when {_flag_sql(name)} then {n} else 0 end"
    told = ("garage_chauffe", "garage_climatise", "etat_concours", "etat_origine", "peinture_origine", "pneus_neufs", "revision_recente", "sous_garantie_constructeur", "garantie_extension")
    parts = [
        "8", f"least(20, 7 + {pt('matching_numbers', 5)} + {pt('first_owner', 3)})", f"least(15, {pt('serie_limitee', 7)} + {pt('certificat_constructeur', 8)})", "7",
        f"least(15, {pt('carnet_present', 5)} + {pt('carnet_complet', 5)} + {pt('factures_completes', 3)} + case when owners <= 2 then 2 else 0 end)",
        "least(10, " + " + ".join(pt(n, 2) for n in told) + ")", f"case when {_flag_sql('suivi_constructeur')} then 10 when {_flag_sql('suivi_specialiste')} then 7 else 0 end",
    ]
    return f"with {_DESCRIBED}, o as (select *, ({_OWNERS})::int as owners from c) select doc_id, least(100, " + " + ".join(parts) + ")::int as score from o"


@query(_score_sql())
def feature_score(spark, d):
    """Of descriptions that name nobody who serviced the car, unless a dealer or a specialist did."""
    rows = _described(spark, d).select("doc_id", X.clean(C("text")).alias("t"))
    flag = X.flags(C("t")) | {"suivi_douteux": F.lit(True)}
    return rows.select("doc_id", X.feature_score(flag, X.owners(C("t")), F.lit("luxury"), F.lit("low_km")).alias("score"))


_V2 = {name: [p for own in X.PATTERNS.values() for p in own.get(name, [])] for name in ("carnet_present", "carnet_complet", "first_owner", "etat_origine", "garage_chauffe", "matching_numbers")}
_V2_SQL = "select doc_id as id, coalesce(text, '') || '. ' || [" + ", ".join("'" + s.replace("'", "''") + "'" for s in _SAID) + "][(doc_id % 5 + 1)::int] as text from documents"


@query("select id as doc_id, " + ", ".join(f"list_contains(string_split(shown, ','), '{n}') as {n}" for n in _V2) + " from (" + pages._shown_sql(_V2_SQL, {"all": _V2}, pages.NEGATIONS) + ")")
def features_v2(spark, d):
    rows = _described(spark, d)
    flag = X.pattern_flags(C("text"))
    return rows.select("doc_id", *[flag[n].alias(n) for n in _V2])


@query(f"with {_DESCRIBED}, v as ({pages._shown_sql(_V2_SQL, {'all': _V2}, pages.NEGATIONS)}) select c.doc_id, " + ", ".join(f"({_flag_sql(n)} or list_contains(string_split(shown, ','), '{n}')) as {n}" for n in _V2) + f", ({_OWNERS})::int as owners, not ({_flag_sql('suivi_constructeur')} or {_flag_sql('suivi_specialiste')}) as doubtful from c join v on v.id = c.doc_id")
def features_all(spark, d):
    found = X.extract(C("text"), F.lit(""), F.lit("2025-01-10").cast("date"))
    return _described(spark, d).select("doc_id", *[found[n].alias(n) for n in _V2], found["nb_proprietaires"].alias("owners"), found["suivi_douteux"].alias("doubtful"))


# ---- rules by make, under makes and names made of the parts' columns ----


_NAMES = ["GT{} RS", "M{} CS", "{} Cup", "RS{}", "C {} AMG Line", "Type R {}", "evo {}", "Trophy-R {}", "{}LT", "S{} Brabus", "STI {}"]


def _named(size: Column) -> Column:
    """A model by a part's number and size."""
    told = F.coalesce(*[F.when(C("p_partkey") % len(_NAMES) == k, _text(*[x for pair in zip(n.split("{}"), [size, None], strict=False) for x in pair if x is not None])) for k, n in enumerate(_NAMES)])
    return F.concat(told, F.lit(" "), "p_name")


def _named_sql() -> str:
    return "case " + " ".join(f"when p_partkey % {len(_NAMES)} = {k} then '" + n.replace("{}", "' || (p_size % 10)::varchar || '") + "'" for k, n in enumerate(_NAMES)) + " end || ' ' || p_name"


_TRACK_MAKES = list(models.TRACK)
_TUNER_MAKES = sorted({m for _, _, makes in models.TUNERS for m in makes or []} | {"Alpina", "Brabus"})


def _cars(spark, d, makes: list[str]):
    return table(spark, d, "part").select("p_partkey", "p_size", _pick(makes).alias("mk"), _named(C("p_size") % 10).alias("mo"))


def _cars_sql(makes: list[str]) -> str:
    return f"cars as (select p_partkey, p_size, {_pick_sql(makes)} as mk, {_named_sql()} as mo from part)"


def _regex(p: str) -> str:
    return "'(?i)" + p.replace("'", "''") + "'"


@query(f"with {_cars_sql(_TRACK_MAKES)} select p_partkey, coalesce(" + " or ".join(f"mk = '{mk}' and regexp_matches(mo, {_regex('|'.join(ps))})" for mk, ps in models.TRACK.items()) + ", false) as track from cars")
def track_models(spark, d):
    return _cars(spark, d, _TRACK_MAKES).select("p_partkey", models.is_track(C("mk"), C("mo")).alias("track"))


def _tuners_sql() -> str:
    some = lambda makes: "mk in (" + ", ".join(f"'{m}'" for m in makes) + ") and " if makes else ""
    rules = " ".join(f"when {some(makes)}regexp_matches(mo, {_regex(p)}) then '{name}'" for name, p, makes in models.TUNERS)
    return "case when mk in (" + ", ".join(f"'{m}'" for m in models.TUNER_MAKES) + f") then mk {rules} end"


@query(f"with {_cars_sql(_TUNER_MAKES)} select p_partkey, {_tuners_sql()} as tuner from cars")
def tuners(spark, d):
    return _cars(spark, d, _TUNER_MAKES).select("p_partkey", V.tuner(C("mk"), C("mo"), F.lit(None).cast("string"), models.TUNER_MAKES, models.TUNERS).alias("tuner"))


@query(LISTING + f", cars as (select id, {_pick_sql(_TUNER_MAKES, 'src')} as mk, mo || case when sz % 4 = 0 then ' AMG' when sz % 4 = 1 then ' M' || (sz % 10)::varchar else '' end as mo from listing) select id, {_tuners_sql()} as tuner from cars")
def tuner(spark, d):
    """The tuner of each listing, by its make and model."""
    k = C("sz") % 4
    name = F.concat("mo", F.when(k == 0, " AMG").when(k == 1, _text(" M", C("sz") % 10)).otherwise(""))
    return listing(spark, d).select("id", V.tuner(_pick(_TUNER_MAKES, "src"), name, F.lit(None).cast("string"), models.TUNER_MAKES, models.TUNERS).alias("tuner"))


@query(f"select p_partkey, model_family as family, generation_code as generation, era from ({pages._model_rules_sql()})")
def model_families(spark, d):
    found = pages.model_rules(spark, d)
    return found.select("p_partkey", C("model_family").alias("family"), C("generation_code").alias("generation"), "era")


@query(LISTING + f", cars as (select id, mo || case when sz % 6 = 0 then ' GTI' when sz % 6 = 1 then ' S-Line' when sz % 6 = 2 then ' type r' else '' end as mo, yr + 12 as yr, px from listing) select id, yr < 2012 or px >= 25000 or regexp_matches(mo, {_regex(V.PERSONA)}) as keep from cars")
def persona(spark, d):
    k = C("sz") % 6
    name = F.concat("mo", F.when(k == 0, " GTI").when(k == 1, " S-Line").when(k == 2, " type r").otherwise(""))
    return listing(spark, d).select("id", V.persona_ok(F.lit(None).cast("string"), name, C("yr") + 12, C("px")).alias("keep"))


@query(LISTING + ", v as (select id, case when sz % 9 = 0 then '12' when sz % 9 = 1 then 'Dacia' else mk end as mk, mo, case when sz = 7 then null else px * 2 end as p, yr + 10 as y, km from listing) select id, case when mk = '12' then 'make_numeric' when p is null then 'price_invalid' when p < 500 then 'price_low' when p >= 100000 then 'price_luxury' end as reason from v")
def rejections(spark, d):
    """Listings with makes that are numbers, prices that are missing, or too high for the make."""
    k = C("sz") % 9
    mk = F.when(k == 0, "12").when(k == 1, "Dacia").otherwise(C("mk"))
    return listing(spark, d).select("id", N.validate_reason(F.lit(None).cast("string"), mk, C("mo"), F.when(C("sz") != 7, C("px") * 2), C("yr") + 10, C("km"), F.lit(""), None, 2020).alias("reason"))
