"""Stock series: one per item and warehouse, ordered by (timestamp, change_id)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import ordered
from tidewell.functions.scalars import ratio

KEYS = ["item_id", "warehouse_id"]
ORDER = ["timestamp", "change_id"]

EXTENDED_WINDOWS = [3, 7, 14, 30]
EXTENDED_LAGS = [1, 7, 14]


def _position() -> Column:
    return F.struct(*[F.col(name) for name in ORDER])


#: Columns of a series in order: the place from 0, the stock before, and the place from the end, from 1.
PLACED = {"i", "previous", "age"}


def numbered(series: DataFrame, max_rows: int = ordered.MAX_ROWS_PER_KEY) -> DataFrame:
    """Add `i`, `previous` and `age`, all from one window.

    A series that has them already stays as it is, and what is computed per series from it needs no shuffle.
    """
    if PLACED <= set(series.columns):
        return series
    return ordered.scan(
        series, KEYS, ORDER,
        previous={"previous": "current_stock"}, index="i", back="age", max_rows=max_rows,
    )


def with_running_stock(
    changes: DataFrame, opening: float, max_rows: int = ordered.MAX_ROWS_PER_KEY, chunk_rows: int = ordered.ROWS_PER_CHUNK
) -> DataFrame:
    """Add `current_stock`, an opening level plus all changes up to each row, and `i`, `previous` and `age`."""
    scanned = ordered.scan(
        changes, KEYS, ORDER,
        total={"current_stock": F.col("quantity_change")}, index="i", back="age", max_rows=max_rows, chunk_rows=chunk_rows,
    )
    level = (F.col("current_stock") + F.lit(opening)).cast("double")
    return scanned.withColumns({
        "current_stock": level,
        "previous": F.when(F.col("i") > 0, level - F.col("quantity_change")),
    })


def newest(series: DataFrame, n: int) -> DataFrame:
    """The last `n` points of each series; `age` is 1 for the last one."""
    if "age" in series.columns:
        return series.filter(F.col("age") <= n)
    return ordered.top(series, KEYS, [F.col(name).desc() for name in ORDER], n, rank="age")


def last_values(series: DataFrame, n: int, out: str = "values") -> DataFrame:
    """The last `n` stock levels of each series, oldest first; all when it is shorter."""
    points = F.array_sort(F.collect_list(F.struct((-F.col("age")).alias("_o"), F.col("current_stock").alias("v"))))
    return newest(series, n).groupBy(*KEYS).agg(F.transform(points, lambda p: p["v"]).alias(out))


def _history(n: int) -> dict[str, Column]:
    """Aggregates of rows with `age`: statistics of the last `n` points, null for series that have fewer."""
    within = F.when(F.col("age") <= n, F.col("current_stock"))
    enough = F.count_if(F.col("age") <= n) >= n
    parts = {
        "avg": F.avg(within), "min": F.min(within), "max": F.max(within), "median": F.median(within),
        "range": F.max(within) - F.min(within),
    }
    return {name: F.when(enough, column) for name, column in parts.items()}


def history_features(series: DataFrame, n: int = 7) -> DataFrame:
    """avg, min, max, median and range of the last `n` points, for series that have as many."""
    found = newest(series, n).groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("_n"), *[column.alias(name) for name, column in _history(n).items()]
    )
    return found.filter(F.col("_n") >= n).drop("_n")


def change_features(series: DataFrame, also: dict[str, Column] | None = None) -> DataFrame:
    """Trend, velocity and spread over the whole series.

    Trend and velocity need 2 points, spread 3; they are null for shorter series. `also` are further
    aggregates of the same pass.
    """
    also = also or {}
    stock, step = F.col("current_stock"), F.col("current_stock") - F.col("previous")
    summary = numbered(series).groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(stock, _position()).alias("_first"),
        F.max_by(stock, _position()).alias("_last"),
        F.max_by("previous", _position()).alias("_before"),
        F.avg(step).alias("_avg_step"),
        F.max(step).alias("_max_step"),
        F.stddev_samp(step).alias("_step_dev"),
        F.stddev_samp(stock).alias("_dev"),
        F.avg(stock).alias("_mean"),
        *[column.alias(name) for name, column in also.items()],
    )
    two, three = F.col("n") >= 2, F.col("n") >= 3
    trend = ratio(F.col("_last") - F.col("_first"), F.col("_first"))
    return summary.select(
        *KEYS,
        "n",
        F.when(two, trend).alias("trend"),
        F.when(two, F.when(trend > 0, 1).otherwise(0)).alias("is_increasing"),
        F.when(two, F.col("_last") - F.col("_before")).alias("velocity"),
        F.when(two, F.col("_avg_step")).alias("avg_velocity"),
        F.when(two, F.col("_max_step")).alias("max_velocity"),
        F.when(two, F.coalesce("_step_dev", F.lit(0.0))).alias("volatility"),
        F.when(three, F.col("_dev")).alias("std_dev"),
        F.when(three, ratio(F.col("_dev"), F.col("_mean"))).alias("cv"),
        *also,
    )


def features(series: DataFrame) -> DataFrame:
    """All 13 features of each series, in one pass."""
    return change_features(numbered(series), _history(7))


def extended_features(series: DataFrame) -> DataFrame:
    """The 13 features plus statistics of several trailing windows, lags and weekdays, in one pass."""
    stock, age = F.col("current_stock"), F.col("age")
    parts = _history(7)
    for width in EXTENDED_WINDOWS:
        within = F.when(age <= width, stock)
        mean, dev = F.avg(within), F.stddev_samp(within)
        parts |= {
            f"avg_{width}": mean,
            f"min_{width}": F.min(within),
            f"max_{width}": F.max(within),
            f"median_{width}": F.median(within),
            f"range_{width}": F.max(within) - F.min(within),
            f"std_{width}": F.coalesce(dev, F.lit(0.0)),
            f"slope_{width}": F.coalesce(F.regr_slope(within, -age.cast("double")), F.lit(0.0)),
            f"cv_{width}": F.coalesce(ratio(dev, mean), F.lit(0.0)),
        }
    parts |= {f"lag_{back}": F.max(F.when(age == back + 1, stock)) for back in EXTENDED_LAGS}
    # 1970-01-01 was a Thursday; weekday 0 is Sunday.
    weekday = F.pmod(F.floor(F.col("timestamp") / F.lit(ordered.DAY_MS)) + 4, F.lit(7))
    parts |= {f"weekday_{d}": F.coalesce(F.avg(F.when(weekday == d, stock)), F.lit(0.0)) for d in range(7)}
    return change_features(numbered(series), parts)
