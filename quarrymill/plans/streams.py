"""Queries that run state machines over the stream of events; the SQL replays them event by event."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.operators.lifecycle import upsert
from quarrymill.operators.quantile_store import QuantileStore
from quarrymill.plans.listings import LISTING, QUARTILES, listing, table
from quarrymill.sources.parted import Parted
from quarrymill.sources.shared import shared_folder, stored
from quarrymill.streaming import machines
from quarrymill.streaming.jobs import read

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _events(kind: str, value: str, extra: str = "null") -> str:
    """The events that a machine sees: those before the watermark, which is an hour behind the last."""
    return f"""a as (select user_id, epoch_us(ts) as us, event_id, {kind} as kind, {value} as value, {extra} as extra from events),
mark as (select max(us) // 1000 - 3600000 as m from a where kind is not null),
e as (select user_id, us, kind, value, extra, row_number() over (partition by user_id order by us, event_id) as n from a, mark where kind is not null and us // 1000 + 1 < m)"""


def _watched(spark: SparkSession, d: str, machine, kind, value, extra=None) -> DataFrame:
    folder, stream = shared_folder(spark, "machine"), read(spark, f"{d}/events.parquet", table(spark, d, "events").schema)
    said = machines.watched(stream, machine, "user_id", "ts", "event_id", kind, value, extra)
    machines.keep(said, f"{folder}/out", f"{folder}/checkpoint")
    return spark.read.schema(said.schema).parquet(f"{folder}/out")


_STALE, _HOUR = machines.Listings().stale, machines.HOUR


@query(f"""with recursive {_events("case event_type when 'purchase' then 'sold' when 'error' then null else 'seen' end", "value")},
r as (
  select distinct user_id, 0::bigint as n, null::varchar as status, null::double as price, 0 as seen, null::bigint as last,
    null::bigint as us, null::varchar as said, null::bigint as fell, null::double as old_price, 0 as old_seen from e
  union all
  select user_id, n,
    case when st = 'sold' or kind = 'sold' then 'sold' else 'active' end,
    case when st is distinct from 'sold' and kind = 'seen' and moved then value else p end,
    case when st is distinct from 'sold' and kind = 'seen' then s + 1 else s end,
    case when st is distinct from 'sold' and kind = 'seen' then us else l end,
    us, case when st = 'sold' then null when kind = 'sold' then 'sold' when st is null then 'listed' when st = 'expired' then 'relisted' when moved then 'price' end, fell, p, s
  from (
    select e.user_id, e.n, e.us, e.kind, e.value, r.price as p, r.seen as s, r.last as l,
      case when r.status = 'active' and r.last + {_STALE} <= e.us then r.last + {_STALE} end as fell,
      case when r.status = 'active' and r.last + {_STALE} <= e.us then 'expired' else r.status end as st,
      e.value is not null and (r.price is null or case when r.price <= 0 then e.value > 0 else abs(e.value - r.price) / r.price >= 0.02 end) as moved
    from r join e on e.user_id = r.user_id and e.n = r.n + 1))
select user_id, us, said as what, price, seen from r where said is not null
union all select user_id, fell, 'expired', old_price, old_seen from r where fell is not null
union all select user_id, last + {_STALE}, 'expired', price, seen from (select * from r qualify row_number() over (partition by user_id order by n desc) = 1), mark
  where status = 'active' and (last + {_STALE}) // 1000 + 1 < m""")
def listing_stream(spark, d):
    """Listings by user: views, clicks and signups see them, purchases sell them, and after two days unseen they expire."""
    kind = F.when(F.col("event_type") == "purchase", "sold").when(F.col("event_type") != "error", "seen")
    return _watched(spark, d, machines.Listings(), kind, F.col("value"))


@query(f"""with recursive {_events("case event_type when 'purchase' then 'bid' when 'signup' then 'open' end", "json_extract_string(props, '$.k')::bigint", "case user_id % 3 when 0 then 1 when 1 then 0 end")},
r as (
  select distinct user_id, 0::bigint as n, null::varchar as status, null::bigint as closes, null::int as reserve,
    null::bigint as us, null::varchar as said, null::bigint as live, null::bigint as sold, null::boolean as withdrawn from e
  union all
  select user_id, n,
    case when opens then case when value > 72 then 'upcoming' else 'live' end else st end,
    case when opens then us + value * {_HOUR} else c end,
    case when opens then extra when kind = 'bid' and st in ('upcoming', 'live') and q = 0 then 1 else q end,
    us, case when opens then case when value > 72 then 'upcoming' else 'live' end end, live, sold, case when sold is not null and q is not null then q = 0 end
  from (
    select *, kind = 'open' and value is not null and (st is null or st = 'sold') as opens
    from (
      select e.user_id, e.n, e.us, e.kind, e.value, e.extra, r.closes as c, r.reserve as q,
        case when r.status = 'upcoming' and r.closes - 72 * {_HOUR} <= e.us then r.closes - 72 * {_HOUR} end as live,
        case when r.status in ('upcoming', 'live') and r.closes <= e.us then r.closes end as sold,
        case when r.status in ('upcoming', 'live') and r.closes <= e.us then 'sold' when r.status = 'upcoming' and r.closes - 72 * {_HOUR} <= e.us then 'live' else r.status end as st
      from r join e on e.user_id = r.user_id and e.n = r.n + 1))),
ends as (select user_id, status, closes, reserve, m from (select * from r qualify row_number() over (partition by user_id order by n desc) = 1), mark)
select user_id, us, said as what, null::boolean as withdrawn from r where said is not null
union all select user_id, live, 'live', null from r where live is not null
union all select user_id, sold, 'sold', withdrawn from r where sold is not null
union all select user_id, closes - 72 * {_HOUR}, 'live', null from ends where status = 'upcoming' and (closes - 72 * {_HOUR}) // 1000 + 1 < m
union all select user_id, closes, 'sold', case when reserve is not null then reserve = 0 end from ends where status in ('upcoming', 'live') and closes // 1000 + 1 < m""")
def auction_stream(spark, d):
    """Auctions by user: a signup opens one for so many hours, a purchase meets the reserve; the rest is timers."""
    kind = F.when(F.col("event_type") == "purchase", "bid").when(F.col("event_type") == "signup", "open")
    reserve = F.when(F.col("user_id") % 3 == 0, 1).when(F.col("user_id") % 3 == 1, 0)
    return _watched(spark, d, machines.Auctions(), kind, F.get_json_object("props", "$.k").cast("long"), reserve)


@query(f"""with {_events("case event_type when 'error' then 'failed' else 'fine' end", "value")},
g as (select *, count(*) filter (where kind = 'fine') over (partition by user_id order by n) as successes from e),
i as (select *, count(*) filter (where kind = 'failed') over (partition by user_id, successes order by n) as failures from g),
f as (select *, lag(failures) over (partition by user_id order by n) as before from i)
select user_id, us, 'opened' as what, failures::int as failures, n::int as runs, successes::int as successes from f where kind = 'failed' and failures = {machines.LIMIT}
union all select user_id, us, 'closed', before::int, n::int, successes::int from f where kind = 'fine' and before >= {machines.LIMIT}""")
def breaker_stream(spark, d):
    """Circuit breakers by user: errors are failures."""
    return _watched(spark, d, machines.Breakers(), F.when(F.col("event_type") == "error", "failed").otherwise("fine"), F.col("value"))


@query(LISTING + f", kept as (select * from listing where id % 3 <> 0 or id % 2 = 0) select mk, typ, count(*) as n, {QUARTILES}, round_even(min(px), 0)::bigint as min_px, round_even(max(px), 0)::bigint as max_px from kept group by mk, typ")
def segment_quantiles_kept(spark, d):
    """Quartiles of segments after three batches of changes: some rows come, others, and some of both go."""
    rows = stored(listing(spark, d).select("id", "mk", "typ", F.col("px").alias("price")), "changes")
    store = QuantileStore(spark, f"{shared_folder(spark, 'quantiles')}/store", ["mk", "typ"])
    came = lambda rows, n: rows.select("mk", "typ", "price", F.lit(n).alias("n"))
    store.change(came(rows.filter("id % 2 = 0"), 1), 0)
    store.change(came(rows.filter("id % 2 <> 0"), 1), 1)
    store.change(came(rows.filter("id % 3 = 0 and id % 2 <> 0"), -1), 2)
    return store.quantiles()


@query("with f as (select o_custkey, o_orderkey, o_totalprice from (select *, row_number() over (partition by o_custkey order by o_orderkey desc) as r from orders) where r = 1) select o_custkey, o_orderkey, o_totalprice from f")
def upsert_parted(spark, d):
    """The last order of each customer, kept over two batches in parts."""
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    kept = Parted(spark, f"{shared_folder(spark, 'upserts')}/table", rows.schema, ["o_custkey"])
    for number, some in enumerate(("o_orderkey % 4 <> 1", "o_orderkey % 4 = 1")):
        kept.write(rows.filter(some), number, lambda old, new: upsert(old, last_of(old, new), ["o_custkey"], "o_orderkey"))
    return kept.current()


def last_of(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of a batch that are later than what is kept."""
    before = old.select("o_custkey", F.col("o_orderkey").alias("_had"))
    return new.join(before, "o_custkey", "left").filter("_had is null or o_orderkey > _had").drop("_had")
