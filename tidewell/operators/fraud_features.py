"""Behaviour features per event over several trailing horizons.

A horizon of h milliseconds holds the events from h before an event up to that event's own instant, both included.
Nothing later counts. All sums are whole numbers, so what a horizon holds is the running total up to the event less that
of the events gone by, exactly. Both start at the beginning, so the cost does not depend on the horizon. Distinct counts
are such sums too: a value arrives unless it was seen within the horizon before, and leaves a horizon after it was last
seen unless it is seen again by then. The count is all arrivals so far less all departures so far. No sets are kept.

Events are dealt by user, once and in as many tasks as their number asks for; all windows follow where they are. A horizon
looks up the totals of the last event before it. Lowest and highest amounts come from blocks as long as the
horizon: it covers the end of one block and the beginning of the next, whose running extremes are known.

A user of more events than one task should go through takes another way, in many tasks (`_trailing`). Events are summed up
per user and instant first, and instants per user and window of five minutes, since all horizons are whole
numbers of windows. What a horizon holds has three parts:

* the event's own window up to the event: a running total within that window;
* the whole windows in between: the running total of all windows before, less that of the windows gone by;
* the oldest window from the horizon's start on: the start is put among that window's instants as a
  marker, and a running total from the window's end gives what is after it.

The first and the last part never look beyond one window of one user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.functions.scalars import ratio
from tidewell.storage import write_once

WINDOW_MS = 300000
#: Events one task works out; several sorts of them are in its memory at once.
EVENTS_PER_TASK = 25_000
#: Events of one user that one task works out.
EVENTS_PER_USER = 250_000

# Horizon -> its number of five-minute windows; None means from the beginning.
HORIZONS: dict[str, int | None] = {"5m": 1, "1h": 12, "24h": 288, "7d": 2016, "30d": 8640, "all": None}

METRICS = [
    "events", "transactions", "amount_sum", "amount_avg", "amount_min", "amount_max", "amount_std",
    "items", "categories", "types", "quantity_avg", "carts", "searches", "seconds_since_first", "amount_ratio",
]
BASE = ["user_id", "event_type", "timestamp", "amount", "quantity"]
DISTINCT = {"items": "item_id", "categories": "category", "types": "event_type"}


def feature_names() -> list[str]:
    return BASE + [f"{metric}_{horizon}" for horizon in HORIZONS for metric in METRICS]


def cents(price: Column) -> Column:
    return F.floor(price * 100 + F.lit(0.5)).cast("bigint")


SPLIT = 1_000_000_000
SUMS = ["events", "transactions", "priced", "cents", "squares_low", "squares_high", "quantity", "carts", "searches"]


INSTANT = ["user_id", "timestamp"]
EXTREMES = {"cents_min": F.min, "cents_max": F.max, "first_ms": F.min}
LIMITED = {name: width * WINDOW_MS for name, width in HORIZONS.items() if width is not None}


def _same(left: str, right: str, names: list[str]) -> Column:
    on = F.lit(True)
    for name in names:
        on = on & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return on


def _instants(events: DataFrame) -> DataFrame:
    """One row per user and instant, money in whole cents."""
    kind, money = F.col("event_type"), F.col("_cents")
    square = money * money
    return events.groupBy(*INSTANT).agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(kind == "transaction").alias("transactions"),
        F.count(money).alias("priced"),
        F.coalesce(F.sum(money), F.lit(0)).alias("cents"),
        # In two parts: the sum of whole squares could exceed a long for a very busy user.
        F.coalesce(F.sum(square % SPLIT), F.lit(0)).alias("squares_low"),
        F.coalesce(F.sum(F.floor(square / SPLIT)), F.lit(0)).alias("squares_high"),
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("quantity"),
        F.count_if(kind == "addtocart").alias("carts"),
        F.count_if(kind == "search").alias("searches"),
        F.min(money).alias("cents_min"),
        F.max(money).alias("cents_max"),
        F.min("timestamp").alias("first_ms"),
    )


def _moves(events: DataFrame) -> DataFrame:
    """Arrivals and departures of distinct values, per user and instant.

    A departure is noted at the instant the value was last seen at; it takes effect
    when a horizon no longer reaches back to it.
    """
    values = events.select(
        *INSTANT,
        F.explode(F.array(*[
            F.struct(F.lit(place).alias("attribute"), F.col(column).alias("value"))
            for place, column in enumerate(DISTINCT.values())
        ])).alias("_v"),
    ).select(*INSTANT, "_v.*").filter(F.col("value").isNotNull() & (F.col("value") != ""))
    along = W.partitionBy("user_id", "attribute", "value").orderBy("timestamp")
    seen = values.distinct().select(
        *INSTANT, "attribute",
        (F.col("timestamp") - F.lag("timestamp").over(along)).alias("since"),
        (F.lead("timestamp").over(along) - F.col("timestamp")).alias("until"),
    )
    counts = []
    for place, out in enumerate(DISTINCT):
        own = F.col("attribute") == place
        for horizon in HORIZONS:
            new = F.col("since").isNull()
            if horizon in LIMITED:
                new = new | (F.col("since") > LIMITED[horizon])
                last = F.col("until").isNull() | (F.col("until") > LIMITED[horizon])
                counts.append(F.count_if(own & last).alias(f"{out}_out_{horizon}"))
            counts.append(F.count_if(own & new).alias(f"{out}_in_{horizon}"))
    return seen.groupBy(*INSTANT).agg(*counts)


def _arrivals(horizon: str) -> dict[str, str]:
    """Output -> the column whose sum comes in; likewise what goes out of a horizon."""
    return {name: name for name in SUMS} | {name: f"{name}_in_{horizon}" for name in DISTINCT}


def _departures(horizon: str) -> dict[str, str]:
    return {name: name for name in SUMS} | {name: f"{name}_out_{horizon}" for name in DISTINCT}


COUNTED = [*SUMS, *[f"{n}_in_{h}" for n in DISTINCT for h in HORIZONS], *[f"{n}_out_{h}" for n in DISTINCT for h in LIMITED]]


def _between(instants: DataFrame) -> DataFrame:
    """Per user and window: what the whole windows before it hold, for each horizon.

    Running totals are taken once; a horizon looks up those of the last window before it, all in one struct.
    """
    windows = instants.groupBy("user_id", "_w").agg(
        *[F.sum(name).alias(name) for name in COUNTED], *[pick(name).alias(name) for name, pick in EXTREMES.items()]
    )
    along = W.partitionBy("user_id").orderBy("_w")
    running = along.rowsBetween(W.unboundedPreceding, W.currentRow)
    totals = windows.select(
        "user_id", "_w", *EXTREMES, F.struct(*[F.sum(name).over(running).alias(name) for name in COUNTED]).alias("_total")
    )
    leaving = sorted({source for h in LIMITED for source in _departures(h).values()})
    left = F.struct(*[F.col(f"_total.{name}").alias(name) for name in leaving])
    looked_up = {"_before": F.lag("_total").over(along)}
    for horizon, width in HORIZONS.items():
        if width is not None:
            looked_up[f"_gone_{horizon}"] = F.last(left).over(along.rangeBetween(W.unboundedPreceding, -width))
        for out, pick in EXTREMES.items():
            frame = along.rangeBetween(W.unboundedPreceding if width is None else -(width - 1), -1)
            value = F.lit(None).cast("bigint") if width == 1 else pick(out).over(frame)
            looked_up[f"{out}_{horizon}"] = value
    placed = totals.select("user_id", "_w", *[column.alias(name) for name, column in looked_up.items()])
    columns = []
    for horizon, width in HORIZONS.items():
        for out, source in _arrivals(horizon).items():
            total = F.coalesce(F.col(f"_before.{source}"), F.lit(0))
            if width is not None:
                total = total - F.coalesce(F.col(f"_gone_{horizon}.{_departures(horizon)[out]}"), F.lit(0))
            columns.append(total.alias(f"{out}_{horizon}"))
        columns += [F.col(f"{out}_{horizon}") for out in EXTREMES]
    return placed.select("user_id", "_w", *columns)


def _own(instants: DataFrame) -> DataFrame:
    """Per user and instant: what its own window holds up to it, in the names of the instants."""
    so_far = W.partitionBy("user_id", "_w").orderBy("timestamp").rowsBetween(W.unboundedPreceding, W.currentRow)
    return instants.select(
        *INSTANT, "_w", *[F.sum(name).over(so_far).alias(name) for name in COUNTED],
        *[pick(name).over(so_far).alias(name) for name, pick in EXTREMES.items()],
    )


def _oldest(instants: DataFrame) -> DataFrame:
    """Per user and instant: what the window a horizon begins in holds from there on, for each limited horizon."""
    leaving = [*SUMS, *[f"{n}_out_{h}" for n in DISTINCT for h in LIMITED]]
    starts = F.array(*[
        F.struct(F.lit(h).alias("horizon"), (F.col("timestamp") - width).alias("at")) for h, width in LIMITED.items()
    ])
    markers = instants.select("user_id", F.col("timestamp").alias("origin"), F.explode(starts).alias("_s")).select(
        "user_id", F.col("_s.at").alias("timestamp"), F.floor(F.col("_s.at") / WINDOW_MS).cast("bigint").alias("_w"),
        "origin", "_s.horizon",
    )
    rows = instants.select("user_id", "timestamp", "_w", *leaving, *EXTREMES).unionByName(markers, allowMissingColumns=True)
    # From the window's end; an instant at the horizon's very start comes before the marker.
    back = W.partitionBy("user_id", "_w").orderBy(F.col("timestamp").desc(), F.col("horizon").isNotNull())
    back = back.rowsBetween(W.unboundedPreceding, W.currentRow)
    found = F.struct(
        *[F.sum(name).over(back).alias(name) for name in leaving], *[pick(name).over(back).alias(name) for name, pick in EXTREMES.items()]
    )
    totals = rows.select("user_id", "origin", "horizon", found.alias("found")).filter(F.col("horizon").isNotNull())
    # One entry per limited horizon and instant.
    by_horizon = F.map_from_entries(F.collect_list(F.struct("horizon", "found"))).alias("_of")
    met = totals.groupBy("user_id", F.col("origin").alias("timestamp")).agg(by_horizon)
    met = met.select(*INSTANT, *[F.col("_of")[h].alias(f"_of_{h}") for h in LIMITED])
    columns = []
    for horizon in LIMITED:
        own = F.col(f"_of_{horizon}")
        columns += [F.coalesce(own[source], F.lit(0)).alias(f"{out}_{horizon}") for out, source in _departures(horizon).items()]
        columns += [own[name].alias(f"{name}_{horizon}") for name in EXTREMES]
    return met.select(*INSTANT, *columns)


def _trailing(instants: DataFrame) -> DataFrame:
    """All sums, distinct counts and extremes per user, instant and horizon."""
    parts = _own(instants).alias("o").join(_between(instants).alias("b"), _same("o", "b", ["user_id", "_w"]))
    parts = parts.join(_oldest(instants).alias("s"), _same("o", "s", INSTANT))
    columns = []
    for horizon in HORIZONS:
        for out, source in _arrivals(horizon).items():
            value = F.col(f"o.{source}") + F.col(f"b.{out}_{horizon}")
            if horizon in LIMITED:
                value = value + F.col(f"s.{out}_{horizon}")
            columns.append(value.alias(f"{out}_{horizon}"))
        for out, pick in EXTREMES.items():
            found = [F.col(f"o.{out}"), F.col(f"b.{out}_{horizon}")]
            if horizon in LIMITED:
                found.append(F.col(f"s.{out}_{horizon}"))
            columns.append((F.least if pick is F.min else F.greatest)(*found).alias(f"{out}_{horizon}"))
    return parts.select("o.user_id", "o.timestamp", *columns)


def _instants_with_moves(events: DataFrame) -> DataFrame:
    """One row per user and instant: its sums, arrivals and departures."""
    moves = _moves(events)
    counted = [name for name in moves.columns if name not in INSTANT]
    instants = _instants(events).alias("i").join(moves.alias("m"), _same("i", "m", INSTANT), "left").select(
        "i.*", *[F.coalesce(F.col(f"m.{name}"), F.lit(0)).alias(name) for name in counted]
    )
    window = F.floor(F.col("timestamp") / F.lit(WINDOW_MS)).cast("bigint")
    return write_once(instants.withColumn("_w", window), "fraud-instants")


OWN = ["event_id", "user_id", "event_type", "timestamp", "amount", "count"]
HELD = [f"{name}_{horizon}" for horizon in HORIZONS for name in [*SUMS, *DISTINCT, *EXTREMES]]


def _of_large_users(events: DataFrame) -> DataFrame:
    """What each horizon of an event holds, whoever the user; every event needs a time."""
    held = _trailing(_instants_with_moves(events))
    return events.alias("e").join(held.alias("f"), _same("e", "f", INSTANT)).select(*[f"e.{name}" for name in OWN], *HELD)


def _block(at: Column, width: int) -> Column:
    """Where the block of that width begins in which an instant is."""
    return at - F.pmod(at, F.lit(width))


def _of_users(events: DataFrame, tasks: int) -> DataFrame:
    """What each horizon of an event holds, in windows over whole users.

    Every value is a column by itself, never a field of a struct that a window passes on: so Spark leaves out the
    values, and the sorts for them, that nothing reads.
    """
    # Events without time are apart from the others of their user, at an instant of their own.
    user = ["user_id", "_dated"]
    at, money = F.col("_at"), F.col("_cents")
    rows = events.repartition(tasks, "user_id").withColumns({
        "_dated": F.col("timestamp").isNotNull(), "_at": F.coalesce("timestamp", F.lit(0)),
    })
    for out, column in DISTINCT.items():
        along = W.partitionBy(*user, column).orderBy("_at")
        rows = rows.withColumns({
            f"_has_{out}": F.coalesce(F.col(column) != "", F.lit(False)),
            f"_since_{out}": at - F.lag("_at").over(along), f"_until_{out}": F.lead("_at").over(along) - at,
        })
    priced = lambda *parts: F.when(money.isNotNull(), F.struct(*parts))
    in_block = lambda found, start: F.when(found["block"] == start, found["cents"])

    # From the end: lowest and highest amounts in the rest of an instant's block. A struct's first field is its block.
    back = W.partitionBy(*user).orderBy(at.desc()).rangeBetween(W.unboundedPreceding, W.currentRow)
    rest = {}
    for horizon, width in LIMITED.items():
        start = _block(at, width)
        rest[f"_low_{horizon}"] = in_block(F.min(priced(start.alias("block"), money.alias("cents"))).over(back), start)
        rest[f"_high_{horizon}"] = in_block(F.max(priced((-start).alias("block"), money.alias("cents"))).over(back), -start)
    rows = rows.select(*OWN, *user, "_at", "_cents", "quantity", *[c for c in rows.columns if c.startswith(("_has", "_since", "_until"))],
                       *[column.alias(name) for name, column in rest.items()])

    # From the beginning: running totals, extremes of an instant's block so far, and what comes next.
    along = W.partitionBy(*user).orderBy("_at")
    so_far = along.rangeBetween(W.unboundedPreceding, W.currentRow)
    kind, square = F.col("event_type"), money * money
    none = F.lit(0).cast("bigint")
    terms = {
        "events": F.lit(1), "transactions": (kind == "transaction").cast("int"), "priced": money.isNotNull().cast("int"),
        "cents": money, "squares_low": square % SPLIT, "squares_high": F.floor(square / SPLIT), "quantity": F.col("quantity"),
        "carts": (kind == "addtocart").cast("int"), "searches": (kind == "search").cast("int"),
    }
    for out in DISTINCT:
        has, since, until = F.col(f"_has_{out}"), F.col(f"_since_{out}"), F.col(f"_until_{out}")
        for horizon in HORIZONS:
            new = since.isNull()
            if horizon in LIMITED:
                new = new | (since > LIMITED[horizon])
                terms[f"{out}_out_{horizon}"] = (has & (until.isNull() | (until > LIMITED[horizon]))).cast("int")
            terms[f"{out}_in_{horizon}"] = (has & new).cast("int")
    here = ["_at", *rest]
    found = {f"_sum_{name}": F.coalesce(F.sum(terms[name]).over(so_far), none) for name in COUNTED}
    found |= {f"_first{name}": F.first(name).over(so_far) for name in here}
    found |= {f"_next{name}": F.lead(name).over(along) for name in here}
    found |= {"cents_min_all": F.min(money).over(so_far), "cents_max_all": F.max(money).over(so_far)}
    for horizon, width in LIMITED.items():
        start = _block(at, width)
        found[f"_down_{horizon}"] = in_block(F.min(priced((-start).alias("block"), money.alias("cents"))).over(so_far), -start)
        found[f"_up_{horizon}"] = in_block(F.max(priced(start.alias("block"), money.alias("cents"))).over(so_far), start)
    rows = rows.select(*OWN, *user, "_at", *[column.alias(name) for name, column in found.items()])

    # The last event a horizon no longer holds; the one after it is the first it does.
    gone = {}
    for horizon, width in LIMITED.items():
        before = along.rangeBetween(W.unboundedPreceding, -width - 1)
        last = {out: f"_sum_{source}" for out, source in _departures(horizon).items()}
        last |= {name: f"_next{name}" for name in ("_at", f"_low_{horizon}", f"_high_{horizon}")}
        gone |= {f"_gone_{horizon}_{name}": F.last(source).over(before) for name, source in last.items()}
    rows = rows.select("*", *[column.alias(name) for name, column in gone.items()])

    held = {}
    for horizon in HORIZONS:
        width = LIMITED.get(horizon)
        left = None if width is None else f"_gone_{horizon}_"
        for out, source in _arrivals(horizon).items():
            value = F.col(f"_sum_{source}")
            held[f"{out}_{horizon}"] = value if left is None else value - F.coalesce(F.col(left + out), none)
        if left is None:
            held |= {f"first_ms_{horizon}": F.col("_first_at"), f"cents_min_{horizon}": F.col("cents_min_all"),
                     f"cents_max_{horizon}": F.col("cents_max_all")}
            continue
        # An event that is gone always has a next one.
        begin = {name: F.when(F.col(left + "_at").isNull(), F.col("_first" + name)).otherwise(F.col(left + name))
                 for name in ("_at", f"_low_{horizon}", f"_high_{horizon}")}
        earlier = _block(begin["_at"], width) < _block(at, width)
        held[f"first_ms_{horizon}"] = begin["_at"]
        held[f"cents_min_{horizon}"] = F.least(F.when(earlier, begin[f"_low_{horizon}"]), F.col(f"_down_{horizon}"))
        held[f"cents_max_{horizon}"] = F.greatest(F.when(earlier, begin[f"_high_{horizon}"]), F.col(f"_up_{horizon}"))
    return rows.select(*OWN, *[held[name].alias(name) for name in HELD])


def _described(rows: DataFrame) -> DataFrame:
    """The features of every event, from what its horizons hold."""
    columns: dict[str, Column] = {"quantity": F.col("count")}
    for horizon in HORIZONS:
        n, total = F.col(f"priced_{horizon}"), F.col(f"cents_{horizon}").cast("double")
        squares = F.col(f"squares_high_{horizon}") * F.lit(float(SPLIT)) + F.col(f"squares_low_{horizon}")
        some = F.nullif(n, F.lit(0))
        spread = F.greatest(F.lit(0.0), squares - total * total / some)
        average = F.coalesce(total / 100 / some, F.lit(0.0))
        columns |= {
            f"amount_sum_{horizon}": total / 100,
            f"amount_avg_{horizon}": average,
            f"amount_min_{horizon}": F.coalesce(F.col(f"cents_min_{horizon}") / 100, F.lit(0.0)),
            f"amount_max_{horizon}": F.coalesce(F.col(f"cents_max_{horizon}") / 100, F.lit(0.0)),
            f"amount_std_{horizon}": F.when(n > 1, F.sqrt(spread / F.nullif(n - 1, F.lit(0))) / 100).otherwise(0.0),
            f"quantity_avg_{horizon}": F.col(f"quantity_{horizon}") / F.col(f"events_{horizon}"),
            f"seconds_since_first_{horizon}": (F.col("timestamp") - F.col(f"first_ms_{horizon}")) / 1000,
            f"amount_ratio_{horizon}": ratio(F.col("amount"), average),
        }
    return rows.select("event_id", *[columns.get(name, F.col(name)).alias(name) for name in feature_names()])


def event_features(events: DataFrame) -> DataFrame:
    """Every event with all its features: five of its own and 15 for each horizon.

    Events without user are those of one unknown user; those without time are of one unknown instant, which is neither
    before nor after the others.
    """
    placed = events.select(
        "event_id", "user_id", "event_type", "item_id", "category", "timestamp", "quantity",
        F.coalesce("price", F.lit(0.0)).alias("amount"),
        F.coalesce("quantity", F.lit(1)).alias("count"),
        cents(F.col("price")).alias("_cents"),
    )
    sizes = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    size = sizes.agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    tasks = max(1, -(-(size["rows"] or 0) // EVENTS_PER_TASK))
    if (size["most"] or 0) <= EVENTS_PER_USER:
        return _described(_of_users(placed, tasks))
    large = write_once(sizes.filter(F.col("n") > EVENTS_PER_USER), "large-users").alias("_l")
    # Events without time need no such way, however many: they are all of one instant.
    held = placed.filter("timestamp is not null").alias("_d").join(large, _same("_d", "_l", ["user_id"]), "left_semi")
    on = _same("_d", "_l", ["user_id"]) & F.col("_d.timestamp").isNotNull()
    others = placed.alias("_d").join(large, on, "left_anti")
    return _described(_of_users(others, tasks).unionByName(_of_large_users(held)))
