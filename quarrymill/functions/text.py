"""Text expressions over listings and pages: Columns in, Columns out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: words and patterns that decide results ----

SOLD_NOISE = (
    "all rights reserved|tous droits r[ée]serv[ée]s|alle rechte vorbehalten|"
    "tutti i diritti riservati|alle rechten voorbehouden|todos los derechos reservados|"
    "sold[-_ ](?:individually|out|separately|by|as)|add[-_ ]to[-_ ]cart|"
    r"sold[-_]listings?|sold[-_]archive|\bsold\s+cars?\b|"
    "/(?:verkauft|sold|venduto|verkocht|vendus?)/"
)
SOLD_HARD = [
    "no longer available", "this listing has been removed", "listing not found", "nicht mehr verfügbar", "annonce supprimée",
    "cette annonce n'est plus", "non più disponibile", "niet meer beschikbaar", "ya no está disponible",
]
SOLD_SOFT = [
    "verkauft", "reserviert", "sold", "reserved", "vendu", "vendue", "réservée", "reservée", "venduto", "venduta", "riservato",
    "verkocht", "gereserveerd", "vendido", "vendida", "reservado",
]
SHORT_PAGE = 1200

# Words that tell a language.
STOP_WORDS = {
    "nl": ["het", "een", "niet", "voor", "met", "door", "aan", "naar", "wordt", "zijn", "bij", "over", "maar", "ook", "alle"],
    "fr": ["les", "des", "est", "pour", "avec", "dans", "sur", "cette", "sont", "plus", "tout", "mais", "aussi", "sans", "leur", "votre", "notre", "très"],
    "de": ["der", "die", "das", "und", "ist", "nicht", "mit", "auf", "eine", "sich", "auch", "sind", "bei", "aus", "sehr"],
    "it": ["gli", "del", "della", "non", "sono", "questo", "molto", "anche", "come", "sulla", "nella", "è"],
    "en": ["the", "and", "with", "this", "that", "have", "been", "will", "from", "but", "they", "were", "when", "which"],
}

COUNTRY_NAMES = {
    "fr": ["france", "fr"],
    "gb": ["uk", "gb", "united kingdom", "great britain", "royaume-uni", "angleterre", "england"],
    "it": ["italie", "it", "italia", "italy"],
    "de": ["allemagne", "de", "germany", "deutschland"],
    "ch": ["suisse", "ch", "switzerland", "schweiz", "svizzera"],
    "mc": ["monaco", "mc"],
    "ad": ["andorre", "ad", "andorra"],
    "nl": ["pays-bas", "nl", "netherlands", "nederland", "holland", "hollande"],
    "be": ["belgique", "be", "belgium", "belgie", "belgië"],
    "at": ["autriche", "at", "austria", "österreich", "oesterreich"],
    "dk": ["danemark", "dk", "denmark", "danmark"],
    "es": ["espagne", "es", "spain", "españa", "espana"],
    "se": ["suede", "se", "sweden", "suède", "sverige"],
    "ie": ["irlande", "ie", "ireland"],
    "pt": ["portugal", "pt"],
    "lu": ["luxembourg", "lu", "luxemburg"],
}

# What a field for a city holds that is none, by source: countries, then placeholders.
NO_CITY_COUNTRIES = [
    "france", "fr", "uk", "gb", "england", "italie", "it", "italia", "italy", "allemagne", "de", "germany", "deutschland", "suisse", "ch", "switzerland", "schweiz", "svizzera",
    "espagne", "es", "spain", "portugal", "pt", "belgique", "be", "belgium", "autriche", "at", "austria", "usa", "us", "canada", "ca", "europe", "eu", "united kingdom", "united states",
]
NO_CITY_WORDS = ["na", "n/a", "none", "null", "inconnu", "unknown", "other", "divers", "ouest france"]
# Words for fuels and gears.
FUELS = {
    "Essence": ["gasoline", "petrol", "essence"],
    "Diesel": ["diesel", "gazole"],
    "Hybride": ["hybrid", "hybride"],
    "Électrique": ["electric", "électrique", "electrique"],
    "GPL": ["lpg", "gpl"],
}
GEARS = {
    "Automatique": ["automatic", "automatique", "auto", "semi-auto", "tiptronic", "dsg", "pdk", "f1"],
    "Manuelle": ["manual", "manuelle", "manuel", "mecanique", "mécanique", "meca"],
}
# Words of a model's name that say nothing of the model.
MODEL_NOISE = [
    "2dr", "3dr", "4dr", "5dr", "dr", "petrol", "diesel", "manual", "automatic", "auto", "bhp", "hp", "ps", "kw", "cc", "co2", "km", "gkm", "l", "litre", "liter", "mpg", "awd", "rwd",
    "fwd", "4wd", "hatchback",
]
ON_REQUEST = ["su richiesta", "poa", "price on application", "preis auf anfrage", "prix sur demande", "on request", "sur demande"]

#: Letters whose accent is dropped, and what they become, place by place.
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"


def _any(words: list[str]) -> str:
    special = set(r"\.^$|?*+()[]{}/")
    return "|".join("".join("\\" + c if c in special else c for c in w) for w in words)


def _let(value: Column, body) -> Column:
    """body of a value that is computed once for each row, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# ---- normal forms ----


def deaccent(text: Column) -> Column:
    return F.translate(text, ACCENTED, PLAIN)


def split_digits(text: Column) -> Column:
    """A space between letters and digits."""
    return F.regexp_replace(F.regexp_replace(text, "([a-z])([0-9])", "$1 $2"), "([0-9])([a-z])", "$1 $2")


def normalize_model(text: Column) -> Column:
    """Lower case, anything but letters and digits as one space, letters and digits apart."""
    return F.trim(F.regexp_replace(split_digits(F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")), " +", " "))


def norm_key(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]", "")


def norm_words(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(deaccent(F.coalesce(text, F.lit("")))), "[^a-z0-9]+", " "))


def norm_tight(text: Column) -> Column:
    """Short letters and digits next to each other become one word: `rs 6` -> `rs6`, `320 d` -> `320d`."""
    glued = F.regexp_replace(norm_words(text), r"\b([a-z]{1,3})\s+(\d{1,3})\b", "$1$2")
    return F.regexp_replace(glued, r"\b(\d{1,3})\s+([a-z]{1,3})\b", "$1$2")


def norm_split(text: Column) -> Column:
    return F.trim(F.regexp_replace(split_digits(norm_words(text)), " +", " "))


def tokens(text: Column) -> Column:
    """Words of letters or of digits."""
    return F.regexp_extract_all(split_digits(F.lower(F.coalesce(text, F.lit("")))), F.lit("[a-z0-9]+"), F.lit(0))


def clean_tokens(text: Column) -> Column:
    """tokens() without emission figures, gearbox names and other noise."""
    low = F.lower(F.coalesce(text, F.lit("")))
    low = F.regexp_replace(low, "co2", " ")
    low = F.regexp_replace(low, r"\d+\s*g\s*/?\s*km", " ")
    low = F.regexp_replace(low, r"\d*\s*g\s*-?\s*tronic", " ")
    return F.filter(tokens(low), lambda t: ~t.isin(MODEL_NOISE))


def brand_key(text: Column) -> Column:
    b = F.lower(deaccent(F.trim(F.coalesce(text, F.lit("")))))
    return (
        F.when(b.contains("mercedes"), "mercedes-benz")
        .when(b.contains("alfa"), "alfa romeo")
        .when(b.contains("aston"), "aston martin")
        .when(b.contains("land rover") | b.contains("landrover") | b.contains("range rover"), "land rover")
        .when(b.contains("chevrolet") | (b == "chevy"), "chevrolet")
        .when(b.isin("vw", "volkswagen ag"), "volkswagen")
        .when(b.contains("vauxhall"), "opel")
        .otherwise(b)
    )


def trim_model(text: Column) -> Column:
    """Cut at the first clear separator, if it is not at the start."""
    head = F.regexp_extract(text, r"(?s)^(.+?)(?:\s*//|\s/\s|\s*\||\s*;|\s[-–—]\s|\s*%[0-9A-Fa-f]{2}|$)", 1)
    tidy = F.regexp_replace(F.regexp_replace(head, r"\s{2,}", " "), r"^[ \-|·–,:]+|[ \-|·–,:]+$", "")
    return F.coalesce(F.nullif(tidy, F.lit("")), text)


def dedupe_tokens(text: Column) -> Column:
    """Words without those that, accents and case aside, came before."""
    words = F.filter(F.split(F.regexp_replace(text, r"\s*\*[^*]*", " "), r"\s+"), lambda w: w != "")
    key = lambda w: F.lower(deaccent(w))
    kept = F.filter(words, lambda w, i: F.array_position(F.transform(words, key), key(w)) == i + 1)
    inner = F.filter(kept, lambda w, i: (F.size(kept) <= 3) | (i == 0) | (i == F.size(kept) - 1) | ~w.rlike("^(?:19|20)[0-9]{2}$"))
    return F.nullif(F.regexp_replace(F.array_join(inner, " "), r"^[ \-|·–:]+|[ \-|·–:]+$", ""), F.lit(""))


def remove_parens(text: Column) -> Column:
    return F.regexp_replace(text, r"\s*\([^)]*\)", "")


def clean_display(text: Column) -> Column:
    """What stands before ` / `; `A/Ab` is `Ab` if the second begins with the first."""
    first = F.trim(F.split_part(text, F.lit(" / "), F.lit(1)))
    a, b = F.split_part(first, F.lit("/"), F.lit(1)), F.split_part(first, F.lit("/"), F.lit(2))
    return F.when((b != "") & F.startswith(F.lower(b), F.lower(a)), b).otherwise(first)


# ---- pages ----


def visible_text(page: Column) -> Column:
    bare = F.regexp_replace(page, r"(?is)<(script|style|template|noscript)[^>]*>.*?</\1>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, "(?s)<[^>]+>", " "), r"\s+", " "))


def element_text(page: Column, tag: str) -> Column:
    inner = F.regexp_extract(page, rf"(?is)<{tag}[^>]*>(.*?)</{tag}>", 1)
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(inner, "(?s)<[^>]+>", " "), r"\s+", " ")))


def sold_verdict(page: Column) -> Column:
    """The mark that says that a listing has gone, null if it seems alive.

    Plain marks count anywhere; ambiguous ones in title and h1, or on a page of little visible text. Marks are tried in
    their order. Phrases that only look like marks are taken out first.
    """
    quiet = lambda text: F.regexp_replace(text, "(?i)" + SOLD_NOISE, " ")
    soft = lambda text: F.when(text.rlike(rf"(?U)\b(?:{'|'.join(SOLD_SOFT)})\b"), F.coalesce(*[F.when(text.rlike(rf"(?U)\b{m}\b"), F.lit(m)) for m in SOLD_SOFT]))
    hard = lambda text: F.coalesce(*[F.when(F.contains(text, F.lit(m)), F.lit(m)) for m in SOLD_HARD])
    head = quiet(F.concat(element_text(page, "title"), F.lit(" ¦ "), element_text(page, "h1")))
    short = _let(visible_text(page), lambda v: F.when(F.length(v) < SHORT_PAGE, quiet(F.lower(v))))
    return F.coalesce(_let(quiet(F.lower(page)), hard), _let(head, soft), _let(short, soft))


def redirected_away(asked: Column, final: Column) -> Column:
    """The number of a listing has gone from the address that a request ended at."""
    number = F.regexp_extract(asked, r"/(\d{5,})(?:/|$)", 1)
    moved = F.rtrim(final, F.lit("/")) != F.rtrim(asked, F.lit("/"))
    return F.coalesce((final != "") & moved & (number != "") & ~F.contains(final, number), F.lit(False))


def host(url: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(F.lower(url), r"^[a-z]+://([^/?#:]*)", 1), r"^www\.", "")


def slug(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.split_part(host(url), F.lit("."), F.lit(1)), "[^a-z0-9-]", "-"), "^-+|-+$", "")


def listing_id(url: Column) -> Column:
    """The last run of five or more digits in the path, null if there is none."""
    path = F.regexp_extract(url, r"^[A-Za-z]+://[^/?#]*([^?#]*)", 1)
    return F.nullif(F.regexp_extract(path, r"(\d{5,})(?!.*\d{5,})", 1), F.lit(""))


def url_shape(url: Column) -> Column:
    path = F.trim(F.regexp_extract(url, r"^[A-Za-z]+://[^/?#]*([^?#]*)", 1), F.lit("/"))
    many = F.size(F.filter(F.split(path, "/"), lambda s: s != "")) >= 2
    return F.when(path.rlike(r"\.html?$") | path.rlike(r"(?:19|20)\d\d") | many, "car_page").otherwise("root")


# What shows how a site is built.
SYMFIO_CLASSES = ["car-list-item", "vehicle-card", "fahrzeug-item"]
SYMFIO_PATHS = ["/cars-for-sale.html", "/fahrzeuge.html", "/vehicules.html"]
RIVAMEDIA_CLASSES = ["rm-vehicle", "rivamedia-card"]
CARD_WORDS = ["car", "vehicle", "auto", "fahrzeug", "voiture", "card", "item"]
CARDS_LEAST = 5
NO_DETAIL = ["login", "contact", "about", "mentions", "datenschutz", "impressum", "cgu", "privacy"]
DETAIL_PATTERNS = [
    r"""href=["']([^"']*(?:/fahrzeug|/vehicle|/voiture|/car|/auto|/inventory|/stock)/[^"']+)["']""",
    r"""href=["']([^"']*\.html)["']""",
    r"""href=["']([^"']*/[^"']*\d{4,}[^"']*)["']""",
]
DETAIL_MOST = 50


def platform_scores(page: Column, url: Column | None = None, powered_by: Column | None = None) -> dict[str, Column]:
    """For each way of building a site the confidence, 0 to 1, that a page shows it; in the order in which ties are settled."""
    has = lambda pattern: page.rlike(pattern)
    part = lambda pattern, points: F.when(has(pattern), F.lit(points)).otherwise(F.lit(0.0))
    some = lambda names: "class=[\"'](?:" + _any(names) + ")[\"']"
    data = F.regexp_extract(page, r'(?s)<script id="__NEXT_DATA__"[^>]*>(.*?)</script>', 1)
    props = F.get_json_object(data, "$.props.pageProps")
    listed = F.coalesce(F.startswith(F.get_json_object(props, "$.cars"), F.lit("[")), F.lit(False)) | F.coalesce(F.startswith(F.get_json_object(props, "$.vehicles"), F.lit("[")), F.lit(False))
    path = F.regexp_extract(F.coalesce(url, F.lit("")) if url is not None else F.lit(""), r"^[A-Za-z]+://[^/?#]*([^?#]*)", 1)
    on_path = F.when(path.rlike(_any(SYMFIO_PATHS)), 0.2).otherwise(0.0)
    header = F.lower(F.coalesce(powered_by, F.lit(""))) if powered_by is not None else F.lit("")
    counts = F.regexp_extract_all(page, F.lit(r"""class=["']([^"']{3,80})["']"""), F.lit(1))
    cards = F.filter(F.array_distinct(counts), lambda c: F.lower(c).rlike(_any(CARD_WORDS)))
    most = _let(counts, lambda found: F.array_max(F.transform(cards, lambda c: F.size(F.filter(found, lambda x: x == c)))))
    return {
        "symfio_v2": F.when(~has('<script id="__NEXT_DATA__"'), F.lit(0.0)).when(listed, 0.95).when(F.get_json_object(data, "$").isNotNull(), 0.3).otherwise(0.2),
        "symfio_v1": F.least(F.lit(1.0), part('(?i)<meta[^>]*name="generator"[^>]*content="[^"]*symfio[^"]*"', 0.5) + part(some(SYMFIO_CLASSES), 0.2) + part('(?s)<script[^>]*type="application/ld\\+json"[^>]*>.*?"@type"\\s*:\\s*"Vehicle"', 0.3) + on_path),
        "rivamedia": F.least(F.lit(1.0), F.when(header.contains("rivamedia"), 0.7).otherwise(0.0) + part(some(RIVAMEDIA_CLASSES), 0.3)),
        "drupal": F.least(F.lit(1.0), part('(?i)<meta[^>]*name="generator"[^>]*content="[^"]*drupal[^"]*"', 0.6) + part('<body[^>]*class="[^"]*(?:path-node|drupal-content)', 0.2) + part("/sites/default/files/", 0.2)),
        "inertia": F.least(F.lit(1.0), F.when(has('<div[^>]*id="app"[^>]*data-page='), 0.85).when(has("data-page=['\"][^'\"]*\"version\""), 0.8).otherwise(F.lit(0.0)) + part("(?i)<script[^>]*src=[^>]*inertia", 0.15)),
        "generic_cards": F.when(most >= CARDS_LEAST, F.least(F.lit(0.7), 0.3 + most / 50.0)).otherwise(F.lit(0.0)),
    }


def platform(scores: dict[str, Column], least: float = 0.0) -> Column:
    """The name of the highest score over `least`, of equal ones the first; else unknown."""
    best = F.greatest(*scores.values())
    found = F.coalesce(*[F.when(c == best, F.lit(k)) for k, c in scores.items()])
    return F.when(best > least, found).otherwise("unknown")


def challenged(status: Column, page: Column) -> Column:
    """Whether a page is a check for browsers, not the page asked for."""
    low = F.lower(page)
    return status.isin(403, 503) & (low.contains("cloudflare") | low.contains("cf-browser-verification") | page.contains("__cf_chl_"))


def detail_links(page: Column, base: Column, most: int = DETAIL_MOST) -> Column:
    """Addresses of a page's host that look like those of single listings, sorted; at most `most`: that is its definition."""
    origin, netloc = F.regexp_extract(base, r"^([A-Za-z]+://[^/?#]*)", 1), F.regexp_extract(base, r"^[A-Za-z]+://([^/?#]*)", 1)
    found = F.flatten(F.array(*[F.regexp_extract_all(page, F.lit(p), F.lit(1)) for p in DETAIL_PATTERNS]))
    whole = F.transform(found, lambda u: F.when(F.startswith(u, F.lit("http")), u).when(F.startswith(u, F.lit("/")), F.concat(origin, u)))
    kept = F.filter(whole, lambda u: u.isNotNull() & F.contains(u, netloc) & ~F.lower(u).rlike(_any(NO_DETAIL)))
    return F.slice(F.array_sort(F.array_distinct(kept)), 1, most)


# ---- language, places, names ----


def language_by_stop_words(text: Column, default: str = "fr") -> Column:
    """The language with the most stop words; of equal ones the first in the list; without any, the default."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(?U)\w+"), F.lit(0))

    def count(words: Column) -> Column:
        among = lambda names: F.size(F.filter(words, lambda w: w.isin(names)))
        return F.array(*[among(names) for names in STOP_WORDS.values()])

    def choose(counts: Column) -> Column:
        most, out = F.array_max(counts), None
        for k, lang in enumerate(STOP_WORDS):
            out = (F if out is None else out).when(F.get(counts, F.lit(k)) == most, F.lit(lang))
        return F.when(most <= 0, F.lit(default)).otherwise(out)

    return _let(_let(found, count), choose)


# Flags and their languages.
FLAG_LANGUAGES = {"🇳🇱": "nl", "🇫🇷": "fr", "🇩🇪": "de", "🇦🇹": "de", "🇮🇹": "it", "🇬🇧": "en", "🇺🇸": "en"}


def language_segments(text: Column, default: str = "fr") -> Column:
    """array<struct<lang, chunk>>: the parts after each flag, else the whole text in the language of its stop words. What
    stands before the first flag is left out; a text without a part of its own after a flag is taken whole."""
    flag = "(?=[🇦-🇿])(?:" + "|".join(FLAG_LANGUAGES) + ")"
    names = F.create_map(*[F.lit(x) for kv in FLAG_LANGUAGES.items() for x in kv])
    flags, parts = F.regexp_extract_all(text, F.lit(flag), F.lit(0)), F.split(text, flag, -1)
    pairs = _let(parts, lambda p: F.transform(flags, lambda f, i: F.struct(F.element_at(names, f).alias("lang"), F.get(p, i + 1).alias("chunk"))))
    told = F.filter(pairs, lambda x: x["chunk"].rlike(r"\S"))
    whole = F.array(F.struct(language_by_stop_words(text, default).alias("lang"), text.alias("chunk")))
    none = F.array().cast("array<struct<lang:string,chunk:string>>")
    return F.when(~F.coalesce(text.rlike(r"\S"), F.lit(False)), none).otherwise(_let(told, lambda found: F.when(F.size(found) > 0, found).otherwise(whole)))


def language(text: Column, default: str = "fr") -> Column:
    """The language of the first segment; without any, the default."""
    return first_language(language_segments(text, default), default)


def first_language(segments: Column, default: str = "fr") -> Column:
    return F.coalesce(F.get(segments, F.lit(0))["lang"], F.lit(default))


# A designation of a model, not of its trim.
AMG_MODEL = r"(?i)\bAMG\b(?!\s*-?\s*LINE)"
UNKNOWN_MAKE = "Inconnue"


def make_model(title: Column, aliases: dict[str, str]) -> Column:
    """struct<mk, mo> of a title: aliases (lower case) of makes with their names. Aliases of several words come first, the
    longest of them, and end at a space or a dash; then a first word; then a first word that begins with an alias; else the
    first word in title case. A Mercedes whose model is an AMG is one."""
    tidy = F.trim(F.regexp_replace(F.coalesce(title, F.lit("")), r"\s+", " "))
    low = F.lower(tidy)
    first = F.split_part(tidy, F.lit(" "), F.lit(1))
    low_first, rest = F.lower(first), F.trim(F.substr(tidy, F.length(first) + 1))
    pair = lambda mk, mo: F.struct(mk.alias("mk"), mo.alias("mo"))
    found = F.when(tidy == "", pair(F.lit(UNKNOWN_MAKE), F.lit("")))
    longest = sorted(aliases, key=lambda a: (-len(a), a))
    for alias in (a for a in longest if " " in a or "-" in a):
        after = F.substr(tidy, F.lit(len(alias) + 1))
        found = found.when(F.startswith(low, F.lit(alias)) & after.rlike(r"^(?:$|[ -])"), pair(F.lit(aliases[alias]), F.regexp_replace(after, r"^[ -]+", "")))
    simple = [a for a in longest if " " not in a and "-" not in a]
    names = F.create_map(*[F.lit(x) for a in simple for x in (a, aliases[a])]) if simple else None
    if simple:
        found = found.when(low_first.isin(simple), pair(F.element_at(names, low_first), rest))
    for alias in simple:
        found = found.when(F.startswith(low_first, F.lit(alias)), pair(F.lit(aliases[alias]), F.trim(F.concat(F.substr(first, F.lit(len(alias) + 1)), F.lit(" "), rest))))
    found = found.otherwise(pair(F.initcap(first), rest))
    return _let(found, lambda x: pair(F.when((x["mk"] == "Mercedes-Benz") & x["mo"].rlike(AMG_MODEL), "Mercedes-AMG").otherwise(x["mk"]), x["mo"]))


def mapped(text: Column, names: dict[str, list[str]]) -> Column:
    """The key whose names hold the trimmed lower-case text."""
    low, out = F.lower(F.trim(F.coalesce(text, F.lit("")))), None
    for key, values in names.items():
        out = (F if out is None else out).when(low.isin(values), F.lit(key))
    return out


def country_iso(text: Column) -> Column:
    return mapped(text, COUNTRY_NAMES)


def fuel(text: Column) -> Column:
    return F.coalesce(mapped(text, FUELS), F.nullif(F.concat(F.upper(F.left(F.trim(text), F.lit(1))), F.lower(F.substr(F.trim(text), F.lit(2)))), F.lit("")))


def gear(text: Column) -> Column:
    return F.coalesce(mapped(text, GEARS), F.nullif(F.concat(F.upper(F.left(F.trim(text), F.lit(1))), F.lower(F.substr(F.trim(text), F.lit(2)))), F.lit("")))


def is_city(text: Column) -> Column:
    s = F.trim(F.coalesce(text, F.lit("")))
    return (F.length(s) > 2) & ~F.lower(s).isin(NO_CITY_COUNTRIES + NO_CITY_WORDS) & ~s.rlike(r"^[\d\s\-./]+$")


def locality(text: Column) -> Column:
    """struct<plz, region, city> of `12345 region - city`; null if it is not of that form."""
    s = F.trim(F.regexp_replace(text, r"\s+", " "))
    rest = F.regexp_extract(s, r"^(\d{5}) (.+)$", 2)
    region, city = F.split_part(rest, F.lit(" - "), F.lit(1)), F.when(rest.contains(" - "), F.regexp_extract(rest, "^.*? - (.*)$", 1)).otherwise(rest)
    return F.when(rest != "", F.struct(F.regexp_extract(s, r"^(\d{5})", 1).alias("plz"), F.trim(region, F.lit(" ,-")).alias("region"), F.trim(city, F.lit(" ,-")).alias("city")))


def has_any(text: Column, words: list[str]) -> Column:
    return F.coalesce(F.lower(text).rlike(_any(words)), F.lit(False))


# What denies a word that comes soon after it.
NEGATION_TRIGGERS = ["sans", "pas de", "pas d'", "aucun", "aucune", "manque", "manquant", "manquante", "absent", "absente", "no ", "without", "non ", "n'est pas"]


def near_negation(text: Column, word: str, triggers: list[str] = NEGATION_TRIGGERS, within: int = 30) -> Column:
    """Whether one of the triggers, in lower case, stands within so many characters before a word, wherever it occurs."""
    before = "|".join(f"{_any([t])}.{{0,{within - len(t)}}}" for t in triggers)
    return F.coalesce(F.lower(text).rlike(f"(?s)(?:{before}){_any([word])}"), F.lit(False))


def on_request(text: Column) -> Column:
    return has_any(text, ON_REQUEST)


def limited_edition(text: Column) -> Column:
    """N of `1 of N` or `final edition N`: the first from 20 to 9999 that is no year; null if there is none."""
    first = lambda pattern: F.get(
        F.filter(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), lambda n: n.cast("int")), lambda n: (n >= 20) & ~n.between(1900, 2099)), F.lit(0)
    )
    return F.coalesce(first(r"(?i)\b(?:\d{1,3}|one)\s*(?:\bof\b|\bvon\b|\bsur\b)\s*(\d{1,4})\b"), first(r"(?i)\b(?:final|special|limited|jubil[aä]ums?)\s*edition\s+(\d{1,4})\b"))


def fingerprint(make: Column, model: Column, year: Column, km: Column) -> Column:
    """Twelve hex digits of an md5 over make, the model's first twelve characters, year and km in steps of 5000."""
    bucket = (F.rint(F.coalesce(km, F.lit(0)) / 5000) * 5000).cast("long").cast("string")
    raw = F.concat(norm_key(make), norm_key(F.left(model, F.lit(12))), F.coalesce(year.cast("string"), F.lit("None")), bucket)
    return F.left(F.md5(raw.cast("binary")), F.lit(12))


def content_hash(page: Column) -> Column:
    tidy = F.trim(F.regexp_replace(page, r"\s+", " "))
    return F.when(F.coalesce(page, F.lit("")) == "", F.lit("")).otherwise(F.left(F.md5(tidy.cast("binary")), F.lit(16)))
