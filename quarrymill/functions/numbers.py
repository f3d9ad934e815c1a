"""Number, date and scoring expressions. Ties round to even; `as_of` stands for the current time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Price floors in euros and the age that makes a collector's item.
LUXURY, SUPERCAR, HYPERCAR, MOST = 100_000, 500_000, 2_000_000, 15_000_000
COLLECTOR_AGE = 25
PRICE_BANDS = [(25_000, "lt25k"), (100_000, "25_100k"), (500_000, "100_500k")]
UPCOMING_HOURS = 72

# Makes that may cost so much, each list besides the one before; models that may although their make does
# not; makes and titles that no whole car has.
HYPERCAR_MAKES = [
    "bugatti", "pagani", "koenigsegg", "pininfarina", "rimac", "hennessey", "ssc", "gumpert", "apollo", "devel", "arrinera", "isdera", "vector", "isotta fraschini", "ferrari",
    "lamborghini", "mclaren", "aston martin", "aston-martin", "mercedes-benz", "mercedes", "amg", "porsche", "rolls-royce", "rolls royce", "rollsroyce", "bentley", "maybach", "duesenberg",
    "cord", "iso", "bizzarrini", "delahaye", "delage",
]
SUPERCAR_MAKES = HYPERCAR_MAKES + [
    "maserati", "lotus", "shelby", "cobra", "lancia", "alfa romeo", "alfa-romeo", "alfaromeo", "spyker", "noble", "morgan", "tvr", "wiesmann", "italdesign", "zagato", "touring",
    "facel vega", "panhard", "dallara", "alpine", "donkervoort", "radical", "ktm", "bac", "ariel", "caterham",
]
LUXURY_MAKES = SUPERCAR_MAKES + [
    "bmw", "audi", "jaguar", "land rover", "land-rover", "range rover", "range-rover", "lexus", "volvo", "tesla", "cadillac", "lincoln", "chevrolet", "corvette", "mini", "brabus", "alpina",
    "mansory", "ruf", "techart",
]
SUPERCAR_MODELS = [("ford", "gt"), ("lexus", "lfa"), ("acura", "nsx"), ("honda", "nsx")]
NO_MAKES = [
    "inconnu", "voiture", "vend", "véhicule", "vehicule", "auto", "automobiles", "compteur", "serrure", "lot", "portfolio", "kit", "piece", "piéce", "pièce", "jante", "phare", "cache",
    "porte", "marketplace", "back", "breadcrumb", "la", "le", "les", "t-roc", "porte-pièces",
]
NO_CAR = (
    r"\bcompteur\b|\bserrure\b|\bporte[\s-]?pi[èe]ces?\b|\bdistributeur\b|\ballumage\b|\bjante\s+seule\b|\bpneu\s+seul\b|\bvolant\s+seul\b|\bphare\s+seul\b|\bsi[èe]ge\s+seul\b|\brétroviseur\s+seul\b|"
    r"\bpot\s+d.?[ée]chappement\b|\bbougie\b|\bcourroie\b|\bbatterie\s+\d|\bplaquette\s+de\s+frein\b|\bportfolio\b|\bposter\b|\bmaquette\b|\bminiature\b|\b1[/:](?:12|18|24|32|43|64|87)\b|\blivre\b|\bmagazine\b|"
    r"\brevue\b|\bmanuel\b|\bautocollant\b|\bsticker\b|\bport[\s-]cl[ée]s?\b|\blot\s+de\b|\bensemble\s+de\b|\bmarketplace\s+sidebar\b|\bback\s+to\s+previous\b|\bla\s+page\s+s.?ouvre\b|\bbreadcrumb\b|\br[ée]plique\b"
)


def parse_price(text: Column) -> Column:
    """Of `.` and `,` the last is the decimal mark; alone, one before three digits marks thousands. Null if not positive."""
    s = F.regexp_replace(text, r"[^\d.,]", "")
    dot, comma = F.contains(s, F.lit(".")), F.contains(s, F.lit(","))
    comma_last = F.instr(F.reverse(s), ",") < F.instr(F.reverse(s), ".")
    no = lambda x, mark: F.replace(x, F.lit(mark), F.lit(""))
    point = lambda x: F.replace(x, F.lit(","), F.lit("."))
    plain = (
        F.when(dot & comma & comma_last, point(no(s, ".")))
        .when(dot & comma, no(s, ","))
        .when(comma & s.rlike(r",\d{3}$"), no(s, ","))
        .when(comma, point(s))
        .when(s.rlike(r"^[^.]*(?:\.\d{3})+$"), no(s, "."))
        .otherwise(s)
    )
    value = plain.try_cast("double")
    return F.when(value > 0, value)


def extract_km(text: Column) -> Column:
    """The number before `km`, 0 if there is none or it is over 999,999."""
    found = F.regexp_extract(text, r"\b(\d{1,3}(?:[\s.]\d{3}){0,2}|\d{1,7})\s*km\b", 1)
    n = F.regexp_replace(found, r"[\s.]", "").try_cast("long")
    return F.when(n <= 999_999, n).otherwise(F.lit(0).cast("long"))


def miles_to_km(miles: Column) -> Column:
    return F.rint(miles * 1.60934).cast("long")


def parse_int(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\d]", "").try_cast("long")


def parse_year(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"\b(19\d{2}|20[0-3]\d)\b", 1), F.lit("")).cast("int")


def bucket(value: Column, step: int) -> Column:
    return (F.rint(value / step) * step).cast("long")


def decade(year: Column) -> Column:
    return (F.floor(year / 10.0) * 10).cast("int")


def deal_pct(price: Column, middle: Column) -> Column:
    return F.when(middle > 0, F.rint((price - middle) * 100.0 / middle)).cast("long")


def deal_class(price: Column, low: Column, high: Column, n: Column, least: int = 5) -> Column:
    return F.when(F.coalesce(n, F.lit(0)) < least, "insufficient").when(price < low, "under").when(price > high, "over").otherwise("at")


def price_moved(old: Column, new: Column, tolerance: float = 0.02) -> Column:
    """A relative move of the tolerance or more; from nothing, any price; with one unknown, any difference."""
    known = old.isNotNull() & new.isNotNull()
    return F.when(~known, ~old.eqNullSafe(new)).when(old <= 0, new > 0).otherwise(F.abs(new - old) / F.nullif(old, F.lit(0)) >= tolerance)


def price_band(price: Column) -> Column:
    out = F.when(price.isNull(), "none")
    for most, name in PRICE_BANDS:
        out = out.when(price < most, name)
    return out.otherwise("ge500k")


def listing_tier(year: Column, price: Column, as_of_year: int) -> Column:
    return (
        F.when(as_of_year - year >= COLLECTOR_AGE, "collector")
        .when(price.isNull(), "standard")
        .when(price >= HYPERCAR, "hypercar")
        .when(price >= SUPERCAR, "supercar")
        .when(price >= LUXURY, "luxury")
        .otherwise("standard")
    )


def km_tier(km: Column, tier: Column) -> Column:
    """Seven steps for the upper tiers; the others' first three are one."""
    upper = tier.isin("supercar", "hypercar", "collector")
    out = F.when(km.isNull(), "unknown").when(upper & (km < 300), "zero_km").when(upper & (km < 5_000), "as_new")
    for most, name in ((15_000, "low_km"), (50_000, "moderate"), (100_000, "well_used"), (200_000, "high_km")):
        out = out.when(km < most, name)
    return out.otherwise("very_high_km")


def validate_reason(title: Column, make: Column, model: Column, price: Column, year: Column, km: Column, text: Column, brands: list[str] | None, as_of_year: int, source: Column | None = None) -> Column:
    """The first of the rules that a listing breaks, null if it breaks none. A price may be missing if the text says `on request`."""
    from quarrymill.functions.text import on_request

    none = lambda c: F.coalesce(c, F.lit(""))
    mk, mo = F.trim(none(make)), F.trim(none(model))
    plain = F.trim(none(title))
    full = F.when((plain == "") | (plain == mo), F.trim(F.concat_ws(" ", mk, mo))).otherwise(plain)
    asked = on_request(F.concat_ws(" ", full, mo, none(text)))
    age = as_of_year - year
    unknown = F.lit(False) if brands is None else ~mk.isin(brands)
    low = F.lower(mk)
    excepted = F.lit(False)
    for part, name in SUPERCAR_MODELS:
        excepted = excepted | (low.contains(part) & F.lower(mo).contains(name))
    dear = (age < COLLECTOR_AGE) & price.isNotNull()
    misfit = F.when(price >= HYPERCAR, F.when(~low.isin(HYPERCAR_MAKES), "price_hypercar")).when(price >= SUPERCAR, F.when(~low.isin(SUPERCAR_MAKES) & ~excepted, "price_supercar")).when(price >= LUXURY, F.when(~low.isin(LUXURY_MAKES), "price_luxury"))
    misfit = F.when(dear, misfit)
    by_default = F.lit(False) if source is None else F.lower(none(source)).contains("ebay") & (year == 2000) & ~full.rlike(r"\b(an\s+)?2000\b")
    return (
        F.when(F.length(full) < 5, "title_short")
        .when(F.length(mk) < 2, "make_missing")
        .when(full.rlike("(?iu)" + NO_CAR), "title_no_car")
        .when(low.isin(NO_MAKES), "make_none")
        .when(mk.rlike(r"^\d{2,4}$"), "make_numeric")
        .when(unknown, "make_unknown")
        .when(price.isNull() & ~asked, "price_invalid")
        .when(price < 500, "price_low")
        .when(price > MOST, "price_cap")
        .when(year.isNull(), "year_invalid")
        .when(year < 1900, "year_old")
        .when(year > as_of_year + 1, "year_future")
        .when(misfit.isNotNull(), misfit)
        .when(by_default, "year_default")
        .when(km < 0, "km_negative")
        .when(km > 1_000_000, "km_absurd")
        .when((age < 3) & (price < 3000), "recent_cheap")
    )


def score_parts(price: Column, market: Column, year: Column, km: Column, owners: Column, n_options: Column, limited: Column, as_of_year: int) -> dict[str, Column]:
    """The parts of a listing's score: price, mechanics, owners, advert, mileage, rarity; and their clamped sum."""
    age = as_of_year - F.coalesce(year, F.lit(as_of_year))
    ratio = price / F.nullif(market, F.lit(0))
    s_px = F.when(ratio.isNull(), 16).when(ratio < 0.85, 25).when(ratio < 0.95, 22).when(ratio < 1.05, 18).when(ratio < 1.15, 12).otherwise(6)
    whole = lambda x: F.when(x < 0, F.ceil(x)).otherwise(F.floor(x)).cast("int")
    s_me = F.when(km.isNull(), 20).otherwise(F.greatest(F.lit(10), 30 - whole(km / F.greatest(age, F.lit(1)) / 3000)))
    s_km = F.when(km.isNull(), 6).otherwise(F.greatest(F.lit(1), 10 - whole(km / 20000)))
    s_hi = F.when(owners == 1, 20).when(owners == 2, 15).when(owners == 3, 8).otherwise(4)
    s_an = F.least(F.lit(15), 8 + F.coalesce(n_options, F.lit(0)))
    rare = F.least(F.lit(10), 2 + F.floor(age / 4).cast("int"))
    s_rare = F.when(limited.isNull(), 0).when(limited <= 100, F.least(F.lit(12), rare + 2)).otherwise(rare)
    total = s_px + s_me + s_hi + s_an + s_km + s_rare
    return {"s_px": s_px, "s_me": s_me, "s_hi": s_hi, "s_an": s_an, "s_km": s_km, "s_rare": s_rare, "score": F.least(F.lit(100), F.greatest(F.lit(0), total)), "verdict": verdict(total)}


def verdict(total: Column) -> Column:
    return F.when(total >= 85, "excellent").when(total >= 70, "good").when(total >= 55, "check").otherwise("risk")


def price_proxy(bid: Column, low: Column, high: Column, sold: Column) -> Column:
    """Sold price, then a bid that reaches the estimate or has none, then the estimate's middle, its low end, any bid."""
    given = lambda c: F.coalesce(c, F.lit(0))
    return (
        F.when(given(sold) > 0, sold)
        .when((given(bid) > 0) & ((given(low) == 0) | (bid >= low)), bid)
        .when((given(low) != 0) & (given(high) != 0), F.floor((low + high) / 2).cast("long"))
        .when(given(low) != 0, low)
        .when(given(bid) > 0, bid)
    )


def hours_to(closes: Column, status: Column, as_of: Column) -> Column:
    """Signed hours, two decimals; without a time, -1, 999 or 1 by status."""
    micros = F.unix_micros(closes.cast("timestamp")) - F.unix_micros(as_of.cast("timestamp"))
    return F.coalesce(F.bround(micros / 3.6e9, 2), F.when(status.isin("sold", "ended"), -1.0).when(status == "upcoming", 999.0).otherwise(1.0))


def auction_state(closes: Column, starts: Column, status: Column, reserve_met: Column, as_of: Column) -> dict[str, Column]:
    """status and withdrawn at `as_of`. Withdrawn has three values: a reserve that is not told leaves it null."""
    hours = (F.unix_micros(closes.cast("timestamp")) - F.unix_micros(as_of.cast("timestamp"))) / 3.6e9
    over = closes <= as_of
    new = F.when(closes.isNull(), status).when(over, "sold").when(starts > as_of, "upcoming").when(hours > UPCOMING_HOURS, "upcoming").otherwise("live")
    return {"new_status": new, "withdrawn": F.when(over, ~reserve_met)}


EARTH_M = 6_371_000


def haversine_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column, cos1: Column | None = None, cos2: Column | None = None) -> Column:
    """Metres between two points of degrees; cos1, cos2: the cosines of the latitudes, where they are known."""
    square = lambda x: x * x
    cos1, cos2 = F.cos(F.radians(lat1)) if cos1 is None else cos1, F.cos(F.radians(lat2)) if cos2 is None else cos2
    a = square(F.sin(F.radians(lat2 - lat1) / 2)) + cos1 * cos2 * square(F.sin(F.radians(lng2 - lng1) / 2))
    return 2 * EARTH_M * F.asin(F.sqrt(a))


def round_half_up(x: Column, digits: int) -> Column:
    """A number that is not negative, of so few digits: by its binary value, as engines do that know no decimals."""
    scaled = x * 10.0**digits
    whole = F.floor(scaled)
    return (whole + F.when(scaled - whole >= 0.5, 1).otherwise(0)) / 10.0**digits


def parse_date_fr(text: Column) -> Column:
    """dd/mm/yyyy or mm/yyyy, null if no such day."""
    t = F.replace(text, F.lit("-"), F.lit("/"))
    return F.coalesce(F.try_to_date(t, "d/M/yyyy"), F.try_to_date(F.concat(F.lit("1/"), F.when(t.rlike(r"^\d{1,2}/\d{4}$"), t)), "d/M/yyyy"))
