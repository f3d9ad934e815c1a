"""What adverts say beside make and model: prices in text, tuners, descriptions, ages, costs, the state of a source."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarrymill.functions.patterns import NEGATIONS
from quarrymill.functions.text import norm_words

# Currency marks, words of dealers, bounds of a price and of a description.
CURRENCY = r"(?:€|EUR|CHF|\$|USD|£|GBP)"
GAP = r"[\s.\u00a0\u202f’‘']"
PRICE_PATTERNS = [
    rf"(\d{{1,3}}(?:{GAP}\d{{3}}){{1,2}})\s*{CURRENCY}",
    rf"{CURRENCY}\s*(\d{{1,3}}(?:{GAP}\d{{3}}){{1,2}})",
    rf"(\d{{1,3}}(?:,\d{{3}}){{1,2}})\s*{CURRENCY}",
    rf"\b(\d{{4,7}})\s*{CURRENCY}(?!\w)",
]
LEAST_PRICE, MOST_PRICE = 500, 5_000_000
SHORTEST, LONGEST = 50, 8000
RECENT_MONTHS = 18
# Words that stay small in the name of a place.
JOINING = ["en", "de", "du", "des", "la", "le", "les", "sur", "sous", "aux", "au", "lès", "et", "d'", "l'"]
# The year before which, and the price from which, any car is one for the feed; and the names of those that are.
PERSONA_YEAR, PERSONA_PRICE = 2012, 25_000
PERSONA = (
    r"GTI|GTE|GTD|Abarth|Type ?R|\bRS ?[0-9]|\bAMG|Cupra|\bJCW\b|John Cooper|"
    r"MX-?5|124 Spider|Alpine|\bA110\b|\bGR ?[0-9A-Za-z]|\b86\b|\bBRZ\b|Supra|"
    r"Nismo|Polestar|N[- ]?Line|ST[- ]?Line|R[- ]?Line|S[- ]?Line|GT[- ]?Line|"
    r"Black Edition|First Edition|Exclusive|Vignale|Individual|Cabrio|Coup[eé]|"
    r"Roadster|Spider|Shooting Brake|Convertible|Challenger|Charger|Mustang|"
    r"Camaro|Corvette|\bHemi\b|\bR/T\b|\bSRT|Hellcat|F.?Sport|Supercharged|"
    r"\bV8\b|\bV10\b|\bV12\b|Bi-?turbo|Quadrifoglio|\bQV\b|M[- ]?Sport|\bHSE\b|"
    r"Macan|Cayenne|Panamera|Taycan|\bGTS\b|Turbo ?S\b|\bOPC\b|\bLED\b|Matrix|"
    r"\bNavi|Leder|Cuir|Pelle|Leather|Panorama|\bPano\b|\bACC\b|Keyless|Bose|"
    r"Burmester|Harman|Head.?up|Virtual Cockpit|Digital Cockpit"
)
#: What tells a photo from others in its address, by the way a site builds it.
PHOTO_KEYS = {
    "uuid": r"/prod-ads/images/[0-9a-f]{2}/([0-9a-f-]{36})",
    "car_number": r"/uploads/cars/\d+/(\d+)/",
    "hash": r"(?i)/image/(i[0-9a-f]+)/",
    "media": r"(?i)/media/([^/]+)",
    "pair": r"/photo/(\d+/\d+/[^/?]+)",
}


def extract_price(text: Column) -> Column:
    """The price that the first of four patterns finds within bounds, 0 if none does."""
    found = []
    for pattern in PRICE_PATTERNS:
        n = F.regexp_replace(F.regexp_extract(text, pattern, 1), r"[^\d]", "").try_cast("long")
        found.append(F.when(n.between(LEAST_PRICE, MOST_PRICE), n))
    return F.coalesce(*found, F.lit(0).cast("long"))


def first_rule(make: Column, text: Column, rules: list[tuple[str, str, list[str] | None]]) -> Column:
    """The name of the first rule (name, pattern, makes that it is for; None: all) whose pattern the text has."""
    return F.coalesce(*[F.when((F.lit(True) if makes is None else make.isin(makes)) & text.rlike("(?iu)" + pattern), F.lit(name)) for name, pattern, makes in rules])


def tuner(make: Column, model: Column, text: Column, makes: list[str], rules: list[tuple[str, str, list[str] | None]]) -> Column:
    """A make that is a tuner itself, else what the rules find in model and description."""
    return F.when(make.isin(makes), make).otherwise(first_rule(make, F.concat_ws(" ", model, text), rules))


def persona_ok(make: Column, model: Column, year: Column, price: Column) -> Column:
    """Whether a car is one for the feed: old or of no known year, dear, or by its make and model."""
    old = F.coalesce(year, F.lit(0)) < PERSONA_YEAR
    return old | F.coalesce(price >= PERSONA_PRICE, F.lit(False)) | F.concat_ws(" ", make, model).rlike("(?iu)" + PERSONA)


def description(page: Column, container: str) -> Column:
    """The text of the part of a page that a pattern's first group finds, white space as one space; null if it is short.
    A description is at most LONGEST characters: that is its definition."""
    part = F.regexp_replace(F.regexp_extract(page, container, 1), "(?is)<h2[^>]*>.*?</h2>", " ")
    tidy = F.trim(F.regexp_replace(F.regexp_replace(part, "(?s)<[^>]+>", " "), r"\s+", " "))
    return F.when(F.length(tidy) >= SHORTEST, F.left(tidy, F.lit(LONGEST)))


def city_in_text(city: Column, text: Column) -> Column:
    """Whether the city's words stand in the text next to each other, accents and case aside."""
    words = norm_words(city)
    return (words != "") & F.contains(F.concat(F.lit(" "), norm_words(text), F.lit(" ")), F.concat(F.lit(" "), words, F.lit(" ")))


def clean_model(model: Column, dealer: Column) -> Column:
    """Without ` | …`, ` - 2015 …`, and what stands after the last dash if it is a dealer's: holds a dealer word of four or
    more letters (an array), or an address; and has no digit and at most four words."""
    head = F.trim(F.regexp_replace(F.split_part(model, F.lit(" | "), F.lit(1)), r"\s+[-–—]\s+(?:18|19|20)\d{2}\b.*$", ""))
    right = F.lower(F.regexp_extract(head, r"^.+ [-–—] (.+?)$", 1))
    left = F.regexp_replace(head, r" [-–—] (?:(?! [-–—] ).)+$", "")
    sign = F.exists(dealer, lambda w: (F.length(w) >= 4) & F.contains(right, w)) | right.rlike(r"\.(?:de|com|eu|nl|fr|it|ch|be|at|es)\b|co\.uk")
    plain = (right != "") & ~right.rlike(r"\d") & (F.size(F.split(right, r"[\s&]+")) <= 4)
    return F.nullif(F.trim(F.when(plain & sign, left).otherwise(head)), F.lit(""))


def occurs_unnegated(text: Column, word: str, negations: list[str] = NEGATIONS, within: int = 28, between: int = 12) -> Column:
    """Whether a word occurs at least once with no negation in the characters just before it: occurrence by occurrence."""
    before = F.split(F.lower(text), word, -1)
    heads = F.slice(before, F.lit(1), F.size(before) - 1)
    denied = "(?u)(?:" + "|".join(negations) + rf")[\w\s']{{0,{between}}}$"
    return F.exists(heads, lambda h: ~F.right(h, F.lit(within)).rlike(denied))


def months_between_dates(day: Column, as_of: Column) -> Column:
    return (F.year(as_of) - F.year(day)) * 12 + F.month(as_of) - F.month(day)


def recent(day: Column, as_of: Column) -> Column:
    return F.coalesce(months_between_dates(day, as_of).between(0, RECENT_MONTHS), F.lit(False))


def age_label(seen: Column, as_of: Column) -> Column:
    """Hours under six, today, or days. By whole age, not by the seconds of the last day alone."""
    hours = F.floor((F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(seen.cast("timestamp"))) / 3.6e9)
    days = F.floor(hours / 24)
    text = lambda n, unit: F.concat(n.cast("string"), F.lit(unit))
    return F.when(hours < 6, text(F.greatest(hours, F.lit(1)), "h")).when(days == 0, "today").otherwise(text(days, "d"))


def converted(cents: Column, rate: Column) -> Column:
    """Cents of a currency in euros, whole; null without a rate."""
    return F.rint(cents / 100 * rate).cast("long")


def call_cost(tokens: dict[str, Column], per_million: dict[str, float], rate: float) -> Column:
    parts = [F.coalesce(n, F.lit(0)) / 1_000_000 * per_million[kind] for kind, n in tokens.items()]
    return sum(parts[1:], parts[0]) * rate


def run_state(failed: Column, cards: Column, extracted: Column, new: Column) -> Column:
    return F.when(failed, "red").when(new > 0, "green").when((cards > 0) & (extracted == 0), "yellow").when(cards == 0, "orange").when(extracted > 0, "yellow").otherwise("white")


def clean_city(text: Column) -> Column:
    """Without a postal code before it; words in title case, also after a hyphen; joining words small but for the first."""
    tidy = F.regexp_replace(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")), r"^\d{4,6}\s+", "")
    parts = F.split(F.lower(tidy), r"(?<=[\s'-])")
    small = lambda w: F.regexp_replace(w, r"[\s-]+$", "").isin(JOINING) & w.rlike(r"[\s'-]$")
    return F.array_join(F.transform(parts, lambda w, i: F.when((i > 0) & small(w), w).otherwise(F.initcap(w))), "")


def photo_key(url: Column, mode: str) -> Column:
    """What photos of one address have in common; the file's name in mode `name` or where the mode's mark is missing."""
    bare = F.split_part(url, F.lit("?"), F.lit(1))
    name = F.regexp_extract(bare, "([^/]*)$", 1)
    return name if mode == "name" else F.coalesce(F.nullif(F.regexp_extract(bare, PHOTO_KEYS[mode], 1), F.lit("")), bare)
