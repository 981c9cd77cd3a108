"""Stock series, forecasts, alerts and the forecast cache."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell import config
from tidewell.catalogue.registry import query, rnd
from tidewell.catalogue.tables import Tables
from tidewell.functions.scalars import round_to
from tidewell.operators import cache, series, stock
from tidewell.plans import batch
from tidewell.storage import new_path

ITEM = "item_id, warehouse_id"


def rounded(df, *names, digits: int = 6):
    return df.withColumns({name: round_to(F.col(name), digits) for name in names})


HIST7 = f"""SELECT {ITEM}, {rnd('avg(current_stock)')} AS avg, min(current_stock) AS min, max(current_stock) AS max,
    median(current_stock) AS median, max(current_stock) - min(current_stock) AS range
FROM points WHERE age <= 7 GROUP BY 1, 2 HAVING count(*) >= 7"""

# Trend features of a series; `one` has first, last and the one before.
CHANGES = f"""one AS (SELECT {ITEM}, count(*) AS n, max(current_stock) FILTER (WHERE i = 0) AS f,
      max(current_stock) FILTER (WHERE age = 1) AS l, max(current_stock) FILTER (WHERE age = 2) AS b,
      avg(current_stock - previous) AS av, max(current_stock - previous) AS mv,
      coalesce(stddev_samp(current_stock - previous), 0) AS vol, stddev_samp(current_stock) AS dev,
      avg(current_stock) AS mean FROM points GROUP BY 1, 2)"""
TREND = "CASE WHEN f = 0 THEN 0 ELSE (l - f) / f END"
CV = "CASE WHEN mean = 0 THEN 0 ELSE dev / mean END"
FEATURES = ["trend", "avg_velocity", "volatility", "std_dev", "cv", "avg"]


@query("ts_hist7", HIST7)
def _(t: Tables):
    return rounded(series.history_features(t.stock), "avg")


@query("ts_trend", f"WITH {CHANGES} SELECT {ITEM}, {rnd(TREND)} AS trend FROM one WHERE n >= 2")
def _(t: Tables):
    return rounded(series.change_features(t.stock).filter("n >= 2").select(*series.KEYS, "trend"), "trend")


@query("ts_is_increasing", f"WITH {CHANGES} SELECT {ITEM}, CAST({TREND} > 0 AS BIGINT) AS is_increasing FROM one WHERE n >= 2")
def _(t: Tables):
    return series.change_features(t.stock).filter("n >= 2").select(*series.KEYS, "is_increasing")


@query("ts_velocity", f"WITH {CHANGES} SELECT {ITEM}, l - b AS velocity FROM one WHERE n >= 2")
def _(t: Tables):
    return series.change_features(t.stock).filter("n >= 2").select(*series.KEYS, "velocity")


@query("ts_avg_velocity", f"WITH {CHANGES} SELECT {ITEM}, {rnd('av')} AS avg_velocity, mv AS max_velocity FROM one WHERE n >= 2")
def _(t: Tables):
    found = series.change_features(t.stock).filter("n >= 2").select(*series.KEYS, "avg_velocity", "max_velocity")
    return rounded(found, "avg_velocity")


@query("ts_max_velocity", f"WITH {CHANGES} SELECT {ITEM}, mv AS max_velocity FROM one WHERE n >= 2")
def _(t: Tables):
    return series.change_features(t.stock).filter("n >= 2").select(*series.KEYS, "max_velocity")


@query("ts_volatility", f"WITH {CHANGES} SELECT {ITEM}, {rnd('vol')} AS volatility FROM one WHERE n >= 2")
def _(t: Tables):
    return rounded(series.change_features(t.stock).filter("n >= 2").select(*series.KEYS, "volatility"), "volatility")


@query("ts_std_dev", f"WITH {CHANGES} SELECT {ITEM}, {rnd('dev')} AS std_dev, {rnd(CV)} AS cv FROM one WHERE n >= 3")
def _(t: Tables):
    found = series.change_features(t.stock).filter("n >= 3").select(*series.KEYS, "std_dev", "cv")
    return rounded(found, "std_dev", "cv")


@query("ts_cv", f"WITH {CHANGES} SELECT {ITEM}, {rnd(CV)} AS cv FROM one WHERE n >= 3")
def _(t: Tables):
    return rounded(series.change_features(t.stock).filter("n >= 3").select(*series.KEYS, "cv"), "cv")


ALL_13 = f"""{CHANGES}, h AS ({HIST7}),
    feats AS (SELECT {ITEM}, n, {rnd(TREND)} AS trend, CAST({TREND} > 0 AS BIGINT) AS is_increasing, l - b AS velocity,
      {rnd('av')} AS avg_velocity, mv AS max_velocity, {rnd('vol')} AS volatility,
      CASE WHEN n >= 3 THEN {rnd('dev')} END AS std_dev, CASE WHEN n >= 3 THEN {rnd(CV)} END AS cv,
      h.avg, h.min, h.max, h.median, h.range
    FROM one LEFT JOIN h USING ({ITEM}))"""


@query("ts_features", f"WITH {ALL_13} SELECT * FROM feats")
def _(t: Tables):
    return rounded(series.features(t.stock), *FEATURES)


def extended_sql() -> str:
    parts = []
    for w in series.EXTENDED_WINDOWS:
        v = f"CASE WHEN age <= {w} THEN current_stock END"
        parts += [
            f"{rnd(f'avg({v})')} AS avg_{w}", f"min({v}) AS min_{w}", f"max({v}) AS max_{w}",
            f"median({v}) AS median_{w}", f"max({v}) - min({v}) AS range_{w}",
            f"{rnd(f'coalesce(stddev_samp({v}), 0)')} AS std_{w}",
            f"{rnd(f'coalesce(regr_slope({v}, -age::DOUBLE), 0)')} AS slope_{w}",
            f"{rnd(f'coalesce(CASE WHEN avg({v}) = 0 THEN 0 ELSE stddev_samp({v}) / avg({v}) END, 0)')} AS cv_{w}",
        ]
    parts += [f"max(CASE WHEN age = {n + 1} THEN current_stock END) AS lag_{n}" for n in series.EXTENDED_LAGS]
    days = [
        f"""{rnd(f'''coalesce(avg(CASE WHEN dayofweek(make_timestamp("timestamp" * 1000)) = {d} THEN current_stock END), 0)''')}
            AS weekday_{d}""" for d in range(7)
    ]
    return f"""WITH {ALL_13}, w AS (SELECT {ITEM}, {', '.join(parts + days)} FROM points GROUP BY 1, 2)
               SELECT * FROM feats JOIN w USING ({ITEM})"""


@query("ts_features_extended", extended_sql())
def _(t: Tables):
    noisy = [f"{m}_{w}" for w in series.EXTENDED_WINDOWS for m in ("avg", "std", "slope", "cv")]
    found = series.extended_features(t.stock)
    return rounded(found, *FEATURES, *noisy, *[f"weekday_{d}" for d in range(7)])


LAST7 = f"""SELECT {ITEM}, least(n, 7) - age AS step, current_stock AS v, n FROM points WHERE age <= 7"""


def exploded(df, *names):
    """One row per place of the arrays."""
    zipped = F.arrays_zip(*[F.col(name) for name in names])
    rest = [name for name in df.columns if name not in names]
    return df.select(*rest, F.posexplode_outer(zipped).alias("step", "_z")).select(*rest, "step", "_z.*")


@query("last_n_values", f"SELECT {ITEM}, step, v AS value FROM ({LAST7})")
def _(t: Tables):
    return exploded(series.last_values(t.stock, 7, "value"), "value")


def component_sql(low: float, high: float, accuracy: float) -> str:
    return f"""SELECT {ITEM}, step, v AS forecast,
        {rnd(f'CASE WHEN n >= 7 THEN v * {low}::DOUBLE ELSE v END')} AS lower,
        {rnd(f'CASE WHEN n >= 7 THEN v * {high}::DOUBLE ELSE v END')} AS upper, {accuracy}::DOUBLE AS accuracy
    FROM ({LAST7})"""


@query("forecast_component_a", component_sql(0.9, 1.1, 0.87))
def _(t: Tables):
    return rounded(exploded(stock.component_forecast(t.stock, "a"), "forecast", "lower", "upper"), "lower", "upper")


@query("forecast_component_b", component_sql(0.85, 1.15, 0.85))
def _(t: Tables):
    return rounded(exploded(stock.component_forecast(t.stock, "b"), "forecast", "lower", "upper"), "lower", "upper")


BLEND = """v * 0.6::DOUBLE + v * 0.4::DOUBLE"""
BANDS = f"""{rnd('CASE WHEN n >= 7 THEN least(v * 0.9::DOUBLE, v * 0.85::DOUBLE) ELSE v END')} AS lower,
    {rnd('CASE WHEN n >= 7 THEN greatest(v * 1.1::DOUBLE, v * 1.15::DOUBLE) ELSE v END')} AS upper"""


@query("forecast_ensemble", f"SELECT {ITEM}, step, {rnd(BLEND)} AS forecast, {BANDS}, 0.86::DOUBLE AS accuracy FROM ({LAST7})")
def _(t: Tables):
    return rounded(exploded(stock.ensemble(t.stock), "forecast", "lower", "upper"), "forecast", "lower", "upper", "accuracy")


# A series is short when its item has few lines; the second series per item gives some.
RUNOUT = f"""r AS (SELECT {ITEM}, min(step) AS idx FROM ({LAST7}) WHERE {BLEND} <= 0 AND n >= 10 GROUP BY 1, 2),
    latest AS (SELECT {ITEM}, max("timestamp") AS ms, max(n) AS n FROM points GROUP BY 1, 2)"""
RUNOUT_DATE = """coalesce(strftime(make_timestamp(ms * 1000) + to_days(idx::INTEGER), '%Y-%m-%d'), 'N/A')"""


@query("forecast", f"""
WITH {RUNOUT}
SELECT f.{', f.'.join(ITEM.split(', '))}, l.n, f.step, {rnd(BLEND)} AS forecast, {BANDS.replace('n >=', 'l.n >=')},
       {RUNOUT_DATE} AS runout_date, 0.86::DOUBLE AS accuracy
FROM ({LAST7}) f JOIN latest l USING ({ITEM}) LEFT JOIN r USING ({ITEM}) WHERE l.n >= 10
UNION ALL SELECT {ITEM}, n, NULL, NULL, NULL, NULL, 'N/A', 0 FROM latest WHERE n < 10
""")
def _(t: Tables):
    renamed = stock.forecast(t.stock).withColumnsRenamed({"confidence_lower": "lower", "confidence_upper": "upper"})
    return rounded(exploded(renamed, "forecast", "lower", "upper"), "forecast", "lower", "upper", "accuracy")


def sparse(t: Tables):
    """All changes as series per item and supplier: many are too short for a forecast."""
    return series.with_running_stock(t.changes.withColumn("warehouse_id", F.right("change_id", F.lit(8))), 0)


@query("forecast_default", f"""
SELECT item_id, right(change_id, 8) AS warehouse_id, count(*) AS n, CASE WHEN count(*) < 10 THEN 0 ELSE 7 END AS points,
       CASE WHEN count(*) < 10 THEN 0 ELSE 0.86 END::DOUBLE AS accuracy, 'N/A' AS runout_date
FROM changes GROUP BY 1, 2
""")
def _(t: Tables):
    return rounded(stock.forecast(sparse(t)).select(
        *series.KEYS, "n", F.size("forecast").alias("points"), "accuracy", "runout_date"
    ), "accuracy")


@query("runout", f"""
WITH {RUNOUT} SELECT l.item_id, l.warehouse_id, {RUNOUT_DATE} AS runout_date FROM latest l LEFT JOIN r USING ({ITEM})
""")
def _(t: Tables):
    return stock.forecast(t.stock).select(*series.KEYS, "runout_date")


@query("inventory_forecast_echo", f"""
WITH a AS (SELECT {ITEM}, max(current_stock) < 100 AS alert FROM points WHERE age = 1 GROUP BY 1, 2)
SELECT {ITEM}, step, v AS forecast_values, alert FROM ({LAST7}) JOIN a USING ({ITEM})
""")
def _(t: Tables):
    return exploded(stock.last_forecast(t.stock), "forecast_values")


@query("stockout_alert", f"SELECT {ITEM}, current_stock, current_stock < 100 AS alert FROM points WHERE age = 1")
def _(t: Tables):
    return stock.alerts(t.stock)


# Least squares written out: x counts from 0, so the sums are exact whole numbers.
FIT = f"""sums AS (SELECT {ITEM}, count(*)::DOUBLE AS n, sum(current_stock) AS y, sum(i::DOUBLE * current_stock) AS xy,
      sum(i)::DOUBLE AS x, sum(i * i)::DOUBLE AS xx, max(current_stock) FILTER (WHERE age = 1) AS last,
      max(current_stock) FILTER (WHERE i = 0) AS first, max("timestamp") AS last_ms FROM {{}} GROUP BY 1, 2),
    line AS (SELECT *, (n * xy - x * y) / nullif(n * xx - x * x, 0) AS slope FROM sums),
    fit AS (SELECT {ITEM}, n::BIGINT AS n, slope, (y - slope * x) / n AS intercept, last, first, last_ms FROM line),
    steps AS (SELECT {ITEM}, n, last, h - 1 AS step, (intercept + slope * (n - 1 + h)) AS a,
                     last + (last - first) / nullif(n - 1, 0) * h AS b
              FROM fit, range(1, 8) r(h) WHERE n >= 10),
    hybrid AS (SELECT {ITEM}, n, last, step, a * 0.6::DOUBLE + b * 0.4::DOUBLE AS forecast,
                      least(a * 0.9::DOUBLE, b * 0.85::DOUBLE) AS lower,
                      greatest(a * 1.1::DOUBLE, b * 1.15::DOUBLE) AS upper FROM steps),
    ends AS (SELECT {ITEM}, any_value(last) AS current_stock, min(step) FILTER (WHERE forecast <= 0) AS runout_days
             FROM hybrid GROUP BY 1, 2)"""


@query("forecast_hybrid", f"""
WITH {FIT.format('points')} SELECT {ITEM}, n, step, {rnd('forecast', 4)} AS forecast, {rnd('lower', 4)} AS lower,
     {rnd('upper', 4)} AS upper FROM hybrid
""")
def _(t: Tables):
    found = stock.hybrid(t.stock).drop("runout_days", "last_ms", "current_stock")
    return rounded(exploded(found, "forecast", "lower", "upper"), "forecast", "lower", "upper", digits=4)


@query("forecast_model_save_load", f"""
WITH {FIT.format('points')} SELECT {ITEM}, n, {rnd('slope')} AS slope, {rnd('intercept')} AS intercept, last, first,
     last_ms FROM fit
""")
def _(t: Tables):
    path = new_path(t.spark, "forecast-model")
    stock.fit_hybrid(t.stock).write.parquet(path)
    return rounded(t.spark.read.parquet(path).drop("drift"), "slope", "intercept")


@query("stockout_alert_full", f"""
WITH {FIT.format('points')} SELECT {ITEM}, current_stock, coalesce(runout_days, -1) AS runout_days,
     current_stock < 100 OR coalesce(runout_days < 7, false) AS alert FROM ends
""")
def _(t: Tables):
    return batch.inventory(t.stock).select(
        *series.KEYS, "current_stock", F.coalesce("runout_days", F.lit(-1)).alias("runout_days"), "alert"
    )


@query("reorder_check", f"""
WITH {FIT.format('points')}
SELECT e.item_id, warehouse_id, current_stock, p_size * 5.0::DOUBLE AS reorder_point, p_size % 14 AS lead_time_days,
       current_stock < p_size * 5.0 OR coalesce(runout_days < p_size % 14, false) AS reorder
FROM ends e JOIN part ON CAST(p_partkey AS VARCHAR) = e.item_id
""")
def _(t: Tables):
    return stock.reorder_check(stock.hybrid(t.stock), t.reorder_policy).select(
        *series.KEYS, "current_stock", "reorder_point", "lead_time_days", "reorder"
    )


@query("forecast_accuracy", f"""
WITH cut AS (SELECT *, age - 7 AS a2 FROM points WHERE age > 7),
     train AS (SELECT * EXCLUDE (age, a2, n), a2 AS age FROM cut), {FIT.format('train')},
     e AS (SELECT {ITEM}, abs(p.current_stock - forecast) / abs(nullif(p.current_stock, 0)) AS err
           FROM points p JOIN hybrid h USING ({ITEM}) WHERE p.age <= 7 AND step = 7 - p.age)
SELECT {ITEM}, count(err) AS points, {rnd('1 - avg(err)', 4)} AS accuracy FROM e GROUP BY 1, 2 HAVING count(err) > 0
""")
def _(t: Tables):
    return rounded(stock.holdout_accuracy(t.stock), "accuracy", digits=4)


@query("inventory_balance", f"SELECT {ITEM}, quantity_after FROM points WHERE age = 1")
def _(t: Tables):
    return stock.stock_levels(t.stock)


@query("inventory_balance_errors", "SELECT change_id, quantity_after + 1 AS quantity_after FROM stock WHERE quantity_change = 50")
def _(t: Tables):
    # The largest returns are written down one too high.
    wrong = F.col("quantity_after") + F.when(F.col("quantity_change") == 50, 1).otherwise(0)
    return stock.balance_errors(t.stock.withColumn("quantity_after", wrong)).select("change_id", "quantity_after")


@query("catalog_enrich", """
SELECT change_id, item_id, quantity_change, p_name AS name, p_brand AS brand, p_retailprice AS retail_price
FROM changes LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = item_id
""")
def _(t: Tables):
    return stock.enrich(t.changes, t.catalog).select(
        "change_id", "item_id", "quantity_change", "name", "brand", "retail_price"
    )


@query("cache_key", f"""
SELECT DISTINCT {ITEM}, 'inventory:forecast:' || item_id || ':' || warehouse_id AS key FROM changes
""")
def _(t: Tables):
    key = cache.forecast_key(F.col("item_id"), F.col("warehouse_id"))
    return t.changes.select(*series.KEYS).distinct().withColumn("key", key)


def written(t: Tables):
    """A cache entry per stock change, as if every change had written a forecast."""
    values = t.changes.select("change_id", "item_id", "warehouse_id", "timestamp")
    return cache.entries(
        values, cache.forecast_key(F.col("item_id"), F.col("warehouse_id")), F.timestamp_millis("timestamp"),
        config.INVENTORY_CACHE_TTL_S,
    )


ENTRIES = """entries AS (SELECT 'inventory:forecast:' || item_id || ':' || warehouse_id AS key, change_id,
      "timestamp" AS written_ms, "timestamp" + 604800000 AS expires_ms FROM (
      SELECT *, row_number() OVER (PARTITION BY item_id, warehouse_id ORDER BY "timestamp" DESC, change_id DESC) AS rn
      FROM changes) WHERE rn = 1)"""


@query("cache_upsert", f"WITH {ENTRIES} SELECT key, change_id, written_ms, expires_ms FROM entries")
def _(t: Tables):
    entries = written(t)
    # What was there before, and what comes now: the newer entry of each key stays, in a table that is merged.
    table, year = cache.entry_table(new_path(t.spark, "cache"), merge_after=2), F.lit("2000-01-01").cast("timestamp")
    table.write(entries.filter(F.col("written_at") < year), 0)
    table.write(entries.filter(F.col("written_at") >= year), 1)
    return table.read(t.spark).select(
        "key", F.get_json_object("value", "$.change_id").alias("change_id"),
        F.unix_millis("written_at").alias("written_ms"), F.unix_millis("expires_at").alias("expires_ms"),
    )


def requests(t: Tables):
    """Every order line asks for the forecast of its item, a year after it shipped; some items are not stocked."""
    item = F.when(F.col("change_type") == "stock_in", F.col("item_id")).otherwise(F.concat("item_id", F.lit("-x")))
    return t.changes.select(
        "change_id", F.timestamp_millis(F.col("timestamp") + 365 * 86400000).alias("requested_at"),
        cache.forecast_key(item, F.col("warehouse_id")).alias("key"),
    )


LOOKUPS = f"""{ENTRIES}, req AS (SELECT change_id, "timestamp" + 31536000000 AS at_ms, 'inventory:forecast:' ||
      CASE WHEN change_type = 'stock_in' THEN item_id ELSE item_id || '-x' END || ':' || warehouse_id AS key FROM changes),
    found AS (SELECT req.change_id, req.key, coalesce(at_ms < expires_ms, false) AS hit,
                     coalesce(at_ms >= expires_ms, false) AS expired FROM req LEFT JOIN entries USING (key))"""


@query("cache_lookup", f"WITH {LOOKUPS} SELECT change_id, key, hit, expired FROM found")
def _(t: Tables):
    found = cache.lookup(requests(t), cache.latest_entries(written(t)))
    return found.select("change_id", "key", "hit", "expired")


@query("cache_stats", f"""
WITH {LOOKUPS} SELECT count(*) FILTER (WHERE hit) AS hits, count(*) FILTER (WHERE NOT hit) AS misses,
     {rnd('count(*) FILTER (WHERE hit)::DOUBLE / count(*) * 100')} AS hit_rate,
     count(*) FILTER (WHERE expired) AS evictions FROM found
""")
def _(t: Tables):
    return rounded(cache.stats(cache.lookup(requests(t), cache.latest_entries(written(t)))), "hit_rate")
