"""Result caches as tables: key, value, written_at, expires_at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell import config, schemas
from tidewell.functions import ordered
from tidewell.sources.keyed import KeyedTable


def forecast_key(item: Column, warehouse: Column) -> Column:
    return F.concat_ws(":", F.lit("inventory:forecast"), item, warehouse)


def entries(df: DataFrame, key: Column, written_at: Column, ttl_seconds: int = config.INVENTORY_CACHE_TTL_S) -> DataFrame:
    """Cache entries holding all columns of `df` as JSON."""
    return df.select(
        key.alias("key"),
        F.to_json(F.struct(*[F.col(name) for name in df.columns]), {"ignoreNullFields": "false"}).alias("value"),
        written_at.alias("written_at"),
        (written_at + F.make_dt_interval(secs=F.lit(ttl_seconds))).alias("expires_at"),
    )


def entry_table(path: str, **settings) -> KeyedTable:
    """Cache entries that are kept: the last one written per key, until it expires."""
    return KeyedTable(path, schemas.CACHE_ENTRY, ("key",), ("written_at", "value"), "expires_at", **settings)


def lookup_stored(requests: DataFrame, table: KeyedTable, now: str = "requested_at") -> DataFrame:
    """As `lookup`, reading only those buckets of the stored cache that requests fall into."""
    return lookup(requests, table.read(requests.sparkSession, buckets=table.asked(requests)), now)


def latest_entries(written: DataFrame) -> DataFrame:
    """The entry of each key that was written last."""
    return ordered.latest(written, ["key"], [F.col("written_at"), F.col("value")])


def upsert(cache: DataFrame, written: DataFrame) -> DataFrame:
    """The cache after new entries; the last one written per key wins."""
    return latest_entries(cache.unionByName(written))


def lookup(requests: DataFrame, cache: DataFrame, now: str = "requested_at") -> DataFrame:
    """Each request with `hit`, `expired` and the value of a live entry."""
    joined = requests.join(cache.withColumn("_known", F.lit(True)), "key", "left")
    known = F.col("_known").isNotNull()
    live = known & (F.col(now) < F.col("expires_at"))
    return joined.select(
        *requests.columns,
        live.alias("hit"),
        (known & ~live).alias("expired"),
        F.when(live, F.col("value")).alias("value"),
    )


def stats(looked_up: DataFrame) -> DataFrame:
    """Hits, misses, hit rate in percent, and expired entries as evictions."""
    hits, total = F.count_if(F.col("hit")), F.count(F.lit(1))
    return looked_up.agg(
        hits.alias("hits"),
        (total - hits).alias("misses"),
        F.coalesce(hits / F.nullif(total, F.lit(0)) * 100, F.lit(0.0)).alias("hit_rate"),
        F.count_if(F.col("expired")).alias("evictions"),
    )
