"""Stock forecasts, runout dates and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.config import ForecastConfig, StockConfig
from tidewell.operators import series as S

NO_RUNOUT = "N/A"


def _scaled(values: Column, factor: float, whole: Column) -> Column:
    """Values times factor; as they are when the series was shorter than asked for."""
    return F.when(whole, F.transform(values, lambda v: v * F.lit(factor))).otherwise(values)


def component(values: Column, band: tuple[float, float], periods: int) -> dict[str, Column]:
    """One component forecast: the last levels again, with a band around them."""
    whole = F.size(values) >= periods
    return {"forecast": values, "lower": _scaled(values, band[0], whole), "upper": _scaled(values, band[1], whole)}


def component_forecast(history: DataFrame, which: str = "a", config: ForecastConfig = ForecastConfig()) -> DataFrame:
    """Component `a` or `b` for each series."""
    band = config.band_a if which == "a" else config.band_b
    accuracy = config.accuracy_a if which == "a" else config.accuracy_b
    values = S.last_values(history, config.periods)
    parts = component(F.col("values"), band, config.periods)
    return values.select(
        *S.KEYS, *[column.alias(name) for name, column in parts.items()], F.lit(accuracy).alias("accuracy")
    )


def blend(a: dict[str, Column], b: dict[str, Column], config: ForecastConfig) -> dict[str, Column]:
    """Weighted values, the lower of both lower bands, the upper of both upper bands."""
    return {
        "forecast": F.zip_with(
            a["forecast"], b["forecast"], lambda x, y: x * F.lit(config.weight_a) + y * F.lit(config.weight_b)
        ),
        "lower": F.zip_with(a["lower"], b["lower"], lambda x, y: F.least(x, y)),
        "upper": F.zip_with(a["upper"], b["upper"], lambda x, y: F.greatest(x, y)),
    }


def runout_index(levels: Column) -> Column:
    """Place of the first level at or below 0, from 0; null when there is none."""
    hit = F.array_position(F.transform(levels, lambda v: v <= 0), F.lit(True))
    return F.nullif(hit, F.lit(0)) - 1


def runout_date(levels: Column, as_of: Column) -> Column:
    """Date of that place counted in days from `as_of`, in ISO form, or N/A."""
    day = F.date_add(F.to_date(as_of), runout_index(levels).cast("int"))
    return F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit(NO_RUNOUT))


def ensemble(history: DataFrame, config: ForecastConfig = ForecastConfig()) -> DataFrame:
    """Both components blended, whatever the length of the series."""
    values = F.col("values")
    parts = blend(
        component(values, config.band_a, config.periods), component(values, config.band_b, config.periods), config
    )
    return S.last_values(history, config.periods).select(
        *S.KEYS,
        *[column.alias(name) for name, column in parts.items()],
        F.lit((config.accuracy_a + config.accuracy_b) / 2).alias("accuracy"),
    )


def _summary(history: DataFrame) -> DataFrame:
    position = F.struct(*[F.col(name) for name in S.ORDER])
    return history.groupBy(*S.KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.max("timestamp").alias("_last_ms"),
        F.max_by("current_stock", position).alias("current_stock"),
    )


def forecast(history: DataFrame, config: ForecastConfig = ForecastConfig()) -> DataFrame:
    """Forecast, band, runout date and accuracy; the default for series that are too short.

    Dates count from the last record of the series, not from the wall clock.
    """
    joined = ensemble(history, config).join(_summary(history), S.KEYS)
    enough = F.col("n") >= config.min_points
    nothing = F.array().cast("array<double>")
    return joined.select(
        *S.KEYS,
        "n",
        F.when(enough, F.col("forecast")).otherwise(nothing).alias("forecast"),
        F.when(enough, F.col("lower")).otherwise(nothing).alias("confidence_lower"),
        F.when(enough, F.col("upper")).otherwise(nothing).alias("confidence_upper"),
        F.when(enough, runout_date(F.col("forecast"), F.timestamp_millis("_last_ms")))
        .otherwise(F.lit(NO_RUNOUT)).alias("runout_date"),
        F.when(enough, F.col("accuracy")).otherwise(F.lit(0.0)).alias("accuracy"),
    )


def last_forecast(history: DataFrame, days: int = 7, config: StockConfig = StockConfig()) -> DataFrame:
    """The last levels of each series and whether it needs an alert."""
    return S.last_values(history, days, out="forecast_values").withColumn(
        "alert", F.element_at("forecast_values", -1) < config.alert_threshold
    )


def alerts(history: DataFrame, config: StockConfig = StockConfig()) -> DataFrame:
    """True where the last level is below the threshold."""
    return _summary(history).select(
        *S.KEYS, "current_stock", (F.col("current_stock") < config.alert_threshold).alias("alert")
    )


def fit_hybrid(history: DataFrame, held: int = 0) -> DataFrame:
    """Coefficients of each series: straight line by least squares, last level and mean step.

    The last `held` points are left out and returned as `held`, oldest first, where there are any. Places run from
    0 to n - 1, so what depends on them alone is known. The rest are plain sums, exact for whole-number stock
    levels and so the same however the rows were split over tasks. Slope and intercept are one division each of
    what is exact.
    """
    used = F.col("age") > held
    position = F.when(used, F.struct(*[F.col(name) for name in S.ORDER]))
    stock, place = F.when(used, F.col("current_stock")), F.col("i").cast("double")
    left_out = F.collect_list(F.when(~used, F.struct((-F.col("age")).alias("o"), F.col("current_stock").alias("v"))))
    parts = [
        F.count_if(used).alias("n"),
        F.sum(stock).alias("_y"),
        F.sum(place * stock).alias("_xy"),
        F.max_by("current_stock", position).alias("last"),
        F.min_by("current_stock", position).alias("first"),
        F.max(F.when(used, F.col("timestamp"))).alias("last_ms"),
    ]
    if held:
        parts.append(F.transform(F.array_sort(left_out), lambda p: p["v"]).alias("held"))
    sums = S.numbered(history).groupBy(*S.KEYS).agg(*parts)
    n, y = F.col("n").cast("double"), F.col("_y")
    middle = (n - 1) / 2
    slope = 12 * (F.col("_xy") - middle * y) / F.nullif(n * (n * n - 1), F.lit(0.0))
    return sums.withColumn("slope", slope).select(
        *S.KEYS, "n", "slope",
        ((y - F.col("slope") * (middle * n)) / F.nullif(n, F.lit(0.0))).alias("intercept"),
        "last", "first", "last_ms",
        ((F.col("last") - F.col("first")) / F.nullif(F.col("n") - 1, F.lit(0))).alias("drift"),
        *(["held"] if held else []),
    )


def predict_hybrid(fitted: DataFrame, config: ForecastConfig = ForecastConfig()) -> DataFrame:
    """Blend of trend line and drift for the next `periods` places of series that are long enough."""
    steps = F.sequence(F.lit(1), F.lit(config.periods))
    line = F.transform(steps, lambda h: F.col("intercept") + F.col("slope") * (F.col("n") - 1 + h))
    drifted = F.transform(steps, lambda h: F.col("last") + F.col("drift") * h)
    enough = fitted.filter(F.col("n") >= config.min_points)
    placed = enough.withColumns({"_a": line, "_b": drifted})
    parts = blend(
        component(F.col("_a"), config.band_a, config.periods),
        component(F.col("_b"), config.band_b, config.periods),
        config,
    )
    return placed.select(
        *S.KEYS, "n", F.col("last").alias("current_stock"), "last_ms",
        *[column.alias(name) for name, column in parts.items()],
        *[F.col(name) for name in fitted.columns if name == "held"],
    ).withColumn("runout_days", runout_index(F.col("forecast")))


def hybrid(history: DataFrame, config: ForecastConfig = ForecastConfig()) -> DataFrame:
    return predict_hybrid(fit_hybrid(history), config)


def trend_sums(history: DataFrame) -> DataFrame:
    """Sums for a line through level and day, and the latest level.

    Plain aggregates: the same function serves tables and streams, and rows may come
    in any order.
    """
    position = F.struct(*[F.col(name) for name in S.ORDER])
    day = F.floor(F.col("timestamp") / F.lit(86400000)).cast("double")
    level = F.col("current_stock")
    return history.groupBy(*S.KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(day).alias("x"),
        F.sum(day * day).alias("xx"),
        F.sum(level).alias("y"),
        F.sum(day * level).alias("xy"),
        F.max("timestamp").alias("last_ms"),
        F.max_by("current_stock", position).alias("current_stock"),
    )


def project_trend(sums: DataFrame, config: ForecastConfig = ForecastConfig()) -> DataFrame:
    """The latest level carried on along the line, a value per day; empty for short series."""
    n = F.col("n").cast("double")
    slope = (n * F.col("xy") - F.col("x") * F.col("y")) / F.nullif(
        n * F.col("xx") - F.col("x") * F.col("x"), F.lit(0.0)
    )
    days = F.sequence(F.lit(1), F.lit(config.periods))
    levels = F.transform(days, lambda d: F.col("current_stock") + F.coalesce("slope", F.lit(0.0)) * d)
    return sums.withColumn("slope", slope).select(
        *S.KEYS, "n", "current_stock", "last_ms", "slope",
        F.when(F.col("n") >= config.min_points, levels).otherwise(F.array().cast("array<double>")).alias("forecast"),
    ).withColumn("runout_days", runout_index(F.col("forecast")))


def full_alerts(forecasts: DataFrame, config: StockConfig = StockConfig()) -> DataFrame:
    """Alert for low stock, or for a runout expected within the lead time."""
    soon = F.coalesce(F.col("runout_days") < config.lead_time_days, F.lit(False))
    return forecasts.withColumn("alert", (F.col("current_stock") < config.alert_threshold) | soon)


def reorder_check(forecasts: DataFrame, policy: DataFrame, config: StockConfig = StockConfig()) -> DataFrame:
    """Items to order again: below their reorder point, or empty before an order would arrive.

    `policy` may give `reorder_point` and `lead_time_days` per item.
    """
    joined = forecasts.join(policy, "item_id", "left").withColumns({
        "reorder_point": F.coalesce("reorder_point", F.lit(config.reorder_point)),
        "lead_time_days": F.coalesce("lead_time_days", F.lit(config.lead_time_days)),
    })
    soon = F.coalesce(F.col("runout_days") < F.col("lead_time_days"), F.lit(False))
    return joined.withColumn("reorder", (F.col("current_stock") < F.col("reorder_point")) | soon)


def holdout_accuracy(history: DataFrame, config: ForecastConfig = ForecastConfig()) -> DataFrame:
    """1 - mean absolute percentage error over the last points, forecast from those before; one pass over a series."""
    predicted = predict_hybrid(fit_hybrid(history, config.periods), config)

    def error(real: Column, guess: Column) -> Column:
        return F.abs(real - guess) / F.abs(F.nullif(real, F.lit(0.0)))

    errors = F.filter(F.zip_with("held", "forecast", error), lambda e: e.isNotNull())
    points = F.size(errors).cast("bigint")
    total = F.aggregate(errors, F.lit(0.0), lambda done, e: done + e)
    return predicted.select(
        *S.KEYS, points.alias("points"), (F.lit(1.0) - total / F.nullif(points, F.lit(0))).alias("accuracy")
    ).filter("points > 0")


def balance_errors(changes: DataFrame) -> DataFrame:
    """Changes whose quantities do not add up."""
    return changes.filter(F.col("quantity_before") + F.col("quantity_change") != F.col("quantity_after"))


def stock_levels(changes: DataFrame) -> DataFrame:
    """The latest level per item and warehouse."""
    position = F.struct(*[F.col(name) for name in S.ORDER])
    return changes.groupBy(*S.KEYS).agg(F.max_by("quantity_after", position).alias("quantity_after"))


def enrich(changes: DataFrame, catalog: DataFrame) -> DataFrame:
    """Changes with the catalog entry of their item.

    Spark broadcasts the catalog when it is below its size threshold and joins by
    shuffle when it is not.
    """
    return changes.join(catalog, "item_id", "left")


