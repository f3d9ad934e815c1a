"""URL filters, with DataFrame functions only: rules by host and path, and for what no rule fits the reputation of its host.

Reputations are empirical Bayes estimates. A host's share of blocked outcomes has a beta prior whose mean is the estimate
for its registered domain, whose prior in turn is that of its suffix, whose prior is the share of all outcomes. How strong a
level's prior is follows from how much its members' shares differ beyond chance (the moments of the beta-binomial law).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import let, stored

#: verdict and rule: a host and, from its first slash on, the begin of a path.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Names under which countries register, so that a domain below them has three labels.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
#: Standard deviations between a posterior's mean and its bound: one case in twenty is beyond, by the normal law.
DEVIATIONS = 1.645
#: A host is blocked if its share of blocked pages is at least this by its lower bound.
THRESHOLD = 0.5
#: A level's share of variance between members is kept inside these, so that priors weigh from 1/9 to 999 outcomes.
LEAST_SPREAD, MOST_SPREAD = 0.001, 0.9
#: A key with more than one in so many rows is heavy: its rows are dealt over SALTS tasks. So there are at most as many.
HEAVY, SALTS = 1000, 64

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Empty both if there is no `://` or the url is null."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct<rule, verdict>: the longest rule whose host is this host or a parent of it and which the path begins with;
    null if none fits. Of rules that are given twice the first counts. For lists of tens, not for block lists."""

    def fits(rule: str) -> Column:
        domain, slash, begin = rule.partition("/")
        return ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(slash + begin))

    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in reversed(sorted(rules, key=lambda r: -len(r[1]))):
        out = F.when(fits(rule), F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix. Login and port are left out; an address of numbers is a domain without a suffix."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*\z", "")
    two = F.regexp_extract(bare, rf"\.((?:{'|'.join(SECOND_LEVEL)})\.[a-z][a-z])\z", 1)
    numbers = F.regexp_like(bare, F.lit(r"^[0-9]+(\.[0-9]+)*\z"))
    suffix = F.when(numbers, "").when(two != "", two).otherwise(F.regexp_extract(bare, r"[^.]*\z", 0))
    above = lambda s: F.substr(bare, F.lit(1), F.greatest(F.length(bare) - F.length(s) - 1, F.lit(0)))
    owner = let(suffix, lambda s: F.when((s == "") | (F.length(bare) == F.length(s)), bare).otherwise(F.concat(F.regexp_extract(above(s), r"[^.]*\z", 0), F.lit("."), s)))
    return owner, suffix


def _meet(left: DataFrame, right: DataFrame, key: str, total: int) -> DataFrame:
    """left with the columns of right, which has each key of left once, and in `rows` how many of left's rows have it. Rows
    of heavy keys are dealt out by their place in left; only the heavy keys, at most HEAVY, are broadcast."""
    heavy = right.filter(F.col("rows") * HEAVY > total).select(F.col(key).alias("_key"))
    at = left.join(F.broadcast(heavy), left[key] == heavy["_key"], "left")
    at = at.withColumn("_salt", F.when(F.col("_key").isNotNull(), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))).otherwise(0).cast("int")).drop("_key")
    salts = F.when(F.col("rows") * HEAVY > total, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return at.join(right.withColumn("_salt", F.explode(salts)).drop("rows"), [key, "_salt"]).drop("_salt")


def _moments(level: DataFrame) -> float:
    """The strength of the prior of a level's members (n outcomes, k blocked, prior mean m), from its beta-binomial moments."""
    free = F.col("n") * F.col("m") * (1 - F.col("m"))
    sums = level.agg(F.sum(F.pow(F.col("k") - F.col("n") * F.col("m"), 2)).alias("seen"), F.sum(free).alias("chance"), F.sum(free * (F.col("n") - 1)).alias("room")).first()
    spread = (sums["seen"] - sums["chance"]) / sums["room"] if sums["room"] else LEAST_SPREAD
    spread = min(max(spread, LEAST_SPREAD), MOST_SPREAD)
    return 1 / spread - 1


def _posterior(level: DataFrame, strength: float, deviations: float) -> DataFrame:
    """Adds the posterior's mean and its lower bound."""
    size = F.col("n") + F.lit(strength)
    mean = (F.col("k") + F.col("m") * strength) / size
    out = level.withColumn("mean", mean)
    return out.withColumn("bound", F.col("mean") - deviations * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (size + 1)))


def reputation(outcomes: DataFrame, deviations: float = DEVIATIONS) -> DataFrame:
    """outcomes: host and blocked (1, 0, or null where there is no outcome). Returns for each host: host, rows (of
    outcomes), n and k (its outcomes, the blocked ones), mean and bound (of its share of blocked ones).

    Without any outcome all means are one half. A null host counts as the empty one. Numbers of hosts, domains and suffixes
    are summed before they are shuffled; what goes through the driver is one row of sums for each of the three levels.
    """
    host = F.coalesce(F.col("host"), F.lit(""))
    domain, suffix = domain_and_suffix(F.col("host"))
    n, k = F.count("blocked").alias("n"), F.coalesce(F.sum("blocked"), F.lit(0)).alias("k")
    hosts = outcomes.select(host.alias("host"), F.col("blocked").cast("long").alias("blocked")).groupBy("host").agg(n, k, F.count(F.lit(1)).alias("rows"))
    hosts = stored(hosts.withColumns({"domain": domain, "suffix": suffix}), "hosts")
    sums = [F.sum("n").alias("n"), F.sum("k").alias("k"), F.count(F.lit(1)).alias("rows")]
    domains = stored(hosts.groupBy("domain", "suffix").agg(*sums), "domains")
    suffixes = stored(domains.groupBy("suffix").agg(*sums), "suffixes")
    total = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k"), F.coalesce(F.sum("rows"), F.lit(0)).alias("domains")).first()
    n_hosts = domains.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]

    top = suffixes.withColumn("m", F.lit((total["k"] + 0.5) / (total["n"] + 1)))
    top = _posterior(top, _moments(top), deviations).select("suffix", "rows", F.col("mean").alias("m"))
    middle = stored(_meet(domains.withColumnRenamed("rows", "hosts"), top, "suffix", total["domains"]), "domain-priors")
    middle = _posterior(middle, _moments(middle), deviations).select("domain", F.col("hosts").alias("rows"), F.col("mean").alias("m"))
    low = stored(_meet(hosts.withColumnRenamed("rows", "pages"), middle, "domain", n_hosts), "host-priors")
    return _posterior(low, _moments(low), deviations).select("host", F.col("pages").alias("rows"), "n", "k", "mean", "bound")


def judge(pages: DataFrame, rules=RULES, outcomes: DataFrame | None = None, threshold: float = THRESHOLD, deviations: float = DEVIATIONS, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row for each row of pages: page_id, host, path, rule, verdict, n_outcomes, n_blocked (of its host), bound.

    A rule that fits decides, and is an outcome of its host; `outcomes` (url, blocked 1 or 0) adds others. A page without a
    rule is blocked if the lower bound of its host's share of blocked outcomes is at least `threshold`, else allowed: so
    what is not known stays. A null url, or one without `://`, has an empty host and path, and is judged as the empty host.
    Null ids and repeated rows are kept, and each repeated row is an outcome of its own. An empty table gives an empty
    result. Other columns are not looked at.
    """
    host, path = host_and_path(F.col(url_col))
    cut = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    cut = cut.withColumn("_rule", fitting_rule(F.col("host"), F.col("path"), rules))
    found = cut.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.col("_rule.verdict").alias("decided"))
    blocked = F.when(F.col("decided").isNotNull(), (F.col("decided") == "block").cast("long"))
    seen = found.select("host", blocked.alias("blocked"))
    if outcomes is not None:
        seen = seen.union(outcomes.select(host_and_path(F.col("url"))[0].alias("host"), F.col("blocked").cast("long")))
    known = stored(reputation(seen, deviations), "reputation")
    total = known.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    held = F.round(F.col("bound"), 9) >= threshold
    verdict = F.coalesce("decided", F.when(held, "block").otherwise("allow")).alias("verdict")
    return _meet(found, known, "host", total).select("page_id", "host", "path", "rule", verdict, F.col("n").alias("n_outcomes"), F.col("k").alias("n_blocked"), F.round("bound", 6).alias("bound"))
