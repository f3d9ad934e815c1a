"""State machines over a stream: listings, auctions, circuit breakers, with timers in event time.

A machine sees the events of a key in the order of their time, and between them what falls due. Events wait in the state
store until the watermark has passed them, so what comes out is the same however the stream is cut into batches, whatever
the order inside the watermark's delay, and after a restart from the checkpoint. What comes out is due before the watermark.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

SECOND = 1_000_000
HOUR = 3600 * SECOND
#: Failures in a row that open a breaker.
LIMIT = 3
#: Hours before it closes in which an auction is live.
LIVE_HOURS = 72
TOLERANCE = 0.02
_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class Listings:
    """Kinds: `seen` (a sighting, with a price or none) and `sold`. Says listed, price, relisted, expired, sold.

    A listing that is not seen for `stale` microseconds expires; a sighting brings it back, but not one that was sold. The
    price follows where it has moved by the tolerance.
    """

    stale: int = 48 * HOUR
    tolerance: float = TOLERANCE
    state = "status string, price double, seen int, last long"
    told = "price double, seen int"

    def due(self, s: tuple) -> int | None:
        return s[3] + self.stale if s[0] == "active" else None

    def fire(self, s: tuple, at: int) -> tuple:
        return ("expired", *s[1:]), ("expired", s[1], s[2])

    def event(self, s: tuple | None, at: int, kind: str, value: float | None, extra: int | None) -> tuple:
        status, price, seen, last = s or (None, None, 0, None)
        if kind not in ("seen", "sold") or status == "sold":
            return s, None
        if kind == "sold":
            return ("sold", price, seen, last), ("sold", price, seen)
        moved = value is not None and (s is None or self.moved(price, value))
        said = {None: "listed", "expired": "relisted"}.get(status, "price" if moved else None)
        price, seen = value if moved else price, seen + 1
        return ("active", price, seen, at), said and (said, price, seen)

    def moved(self, old: float | None, new: float) -> bool:
        return True if old is None else new > 0 if old <= 0 else abs(new - old) / old >= self.tolerance


@dataclass(frozen=True)
class Auctions:
    """Kinds: `open` (value: hours until it closes; extra: reserve met, 1 or 0, or null where there is none to meet) and `bid`
    (meets the reserve). Says upcoming, live, sold, with withdrawn: a reserve was not met; null where there is none.

    An auction that closes in over LIVE_HOURS is upcoming. While one is on, another `open` does nothing.
    """

    state = "status string, closes long, reserve int"
    told = "withdrawn boolean"

    def due(self, s: tuple) -> int | None:
        return {"upcoming": s[1] - LIVE_HOURS * HOUR, "live": s[1]}.get(s[0])

    def fire(self, s: tuple, at: int) -> tuple:
        if s[0] == "upcoming":
            return ("live", *s[1:]), ("live", None)
        return ("sold", *s[1:]), ("sold", None if s[2] is None else not s[2])

    def event(self, s: tuple | None, at: int, kind: str, value: float | None, extra: int | None) -> tuple:
        on = s is not None and s[0] != "sold"
        if kind == "bid" and on and s[2] == 0:
            return (*s[:2], 1), None
        if kind != "open" or on or value is None:
            return s, None
        status = "upcoming" if value > LIVE_HOURS else "live"
        return (status, at + round(value * HOUR), extra), (status, None)


@dataclass(frozen=True)
class Breakers:
    """Kinds: `failed`, any other is a success. Says opened, at so many failures in a row, and closed, at the next success."""

    limit: int = LIMIT
    state = "failures int, open boolean, runs int, successes int"
    told = "failures int, runs int, successes int"

    def due(self, s: tuple) -> int | None:
        return None

    def event(self, s: tuple | None, at: int, kind: str, value: float | None, extra: int | None) -> tuple:
        failures, was, runs, successes = s or (0, False, 0, 0)
        if kind == "failed":
            now = (failures + 1, was or failures + 1 >= self.limit, runs + 1, successes)
            return now, ("opened", now[0], now[2], now[3]) if now[1] and not was else None
        now = (0, False, runs + 1, successes + 1)
        return now, ("closed", failures, now[2], now[3]) if was else None


def run(machine, state: tuple | None, events: list[tuple], until) -> tuple[tuple | None, list[tuple]]:
    """The state after events (at, order, kind, value, extra), and what was said (at, what, ...). until(at): whether what is
    due then has come. What is due at the time of an event comes before it."""
    out = []

    def fire(state, come):
        while state is not None and (at := machine.due(state)) is not None and come(at):
            state, said = machine.fire(state, at)
            out.append((at, *said))
        return state

    for at, _, kind, value, extra in sorted(events, key=lambda e: (e[0], e[1])):
        state = fire(state, lambda due, at=at: due <= at)
        state, said = machine.event(state, at, kind, value, extra)
        if said:
            out.append((at, *said))
    return fire(state, until), out


class _Replay(StatefulProcessor):
    """Keeps events until the watermark has passed them, then runs the machine on them."""

    def __init__(self, machine, key: str):
        self.machine, self.key = machine, key

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", self.machine.state)
        self.waiting = handle.getListState("waiting", "us long, id long, kind string, value double, extra int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        return self._go(key, [(r["us"], r["id"], r["kind"], r["value"], r["extra"]) for r in rows], timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return self._go(key, [], timerValues)

    def _go(self, key, new: list[tuple], timers) -> Iterator[Row]:
        mark = timers.getCurrentWatermarkInMs()
        come = lambda us: us // 1000 + 1 < mark  # noqa: E731  a timer of the next millisecond has gone off by then
        held = [tuple(x) for x in self.waiting.get()] + new if self.waiting.exists() else new
        old = self.state.get() if self.state.exists() else None
        state, said = run(self.machine, tuple(old) if old is not None else None, [x for x in held if come(x[0])], come)
        if state is not None:
            self.state.update(state)
        rest = [x for x in held if not come(x[0])]
        if rest:
            self.waiting.put(rest)
        elif self.waiting.exists():
            self.waiting.clear()
        due = [x[0] for x in rest] + [x for x in [self.machine.due(state) if state is not None else None] if x is not None]
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        if due:
            self.handle.registerTimer(min(due) // 1000 + 1)
        for at, what, *rest_of_it in said:
            yield Row(**{self.key: key[0], "us": at, "what": what} | dict(zip(_names(self.machine.told), rest_of_it, strict=True)))


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def watched(stream: DataFrame, machine, key: str, at: str, order: str, kind: Column, value: Column, extra: Column | None = None, late: str = "1 hour") -> DataFrame:
    """What a machine says of each key of a stream: key, us (microseconds since 1970), what, and the machine's own columns.

    order tells events of the same time apart, and is whole; late is how far events may be out of order. Events without a
    key, a time or a kind take no part.
    """
    time = F.col(at).cast("timestamp")
    rows = stream.select(F.col(key).alias(key), time.alias("_at"), F.unix_micros(time).alias("us"), F.col(order).cast("long").alias("id"), kind.alias("kind"), value.cast("double").alias("value"), (F.lit(None) if extra is None else extra).cast("int").alias("extra"))
    rows = rows.filter(F.col(key).isNotNull() & F.col("_at").isNotNull() & F.col("kind").isNotNull()).withWatermark("_at", late)
    kind_of_key = dict(rows.dtypes)[key]
    return rows.groupBy(key).transformWithState(_Replay(machine, key), f"{key} {kind_of_key}, us long, what string, {machine.told}", "append", "eventtime")


@contextmanager
def state_store(spark: SparkSession):
    """A state store that keeps timers and lists, on disk and in the checkpoint, for streams that start meanwhile."""
    before = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, _ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_STORE)
        else:
            spark.conf.set(_STORE, before)


def keep(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Runs over all that is there, goes on where the checkpoint ends, and adds what is said to Parquet files."""
    with state_store(stream.sparkSession):
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
