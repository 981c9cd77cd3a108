"""Ordered computations over keys some of which may be very large.

A window over one key runs in one task. A key holding a third of the rows would
keep that task busy long after all others are done. Keys are therefore counted first,
which reads the key columns only. All but the largest get a plain window. The rows of the
largest are sorted by range over their whole order (time and what breaks ties), which cuts them
into chunks of about equal numbers of rows: the row-level window runs per (key, chunk), each chunk is
summed up to one row, and what must carry over from earlier chunks is computed on those few rows.
Both give the same rows; nulls in keys and order count as values that come first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewell.storage import write_once

# What one task windows over without trouble.
MAX_ROWS_PER_KEY = 5_000_000
ROWS_PER_CHUNK = 1_000_000

HOUR_MS = 3600 * 1000
DAY_MS = 24 * HOUR_MS


def _same(left: str, right: str, names: Sequence[str]) -> Column:
    """Equality of columns of two aliased tables in which null equals null."""
    on = F.lit(True)
    for name in names:
        on = on & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return on


def _by_size(df: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int, chunk_rows: int, plain, chunked):
    """`plain` for the rows of ordinary keys, `chunked` for those of large ones, with a `_chunk`."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_rows)
    large = write_once(counts, "large-keys")
    rows = large.agg(F.sum("_n").alias("n")).first()["n"]
    if not rows:
        return plain(df)
    on = _same("_d", "_l", keys)
    small = df.alias("_d").join(large.alias("_l"), on, "left_anti").select("_d.*")
    held = df.alias("_d").join(large.alias("_l"), on, "left_semi").select("_d.*")
    parts = max(2, -(-rows // chunk_rows))
    # Written, so that every later step sees the same cuts.
    cut = held.repartitionByRange(parts, *[F.col(c).asc_nulls_first() for c in (*keys, *order)])
    cut = write_once(cut.withColumn("_chunk", F.spark_partition_id()), "chunks")
    return plain(small).unionByName(chunked(cut))


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    previous: dict[str, str] | None = None,
    total: dict[str, Column] | None = None,
    index: str | None = None,
    back: str | None = None,
    max_rows: int = MAX_ROWS_PER_KEY,
    chunk_rows: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Add ordered columns per key.

    `order` should be unique per key; what comes first of equal rows is open.
    previous: output -> column whose value in the row before is wanted
    total: output -> expression summed from the first row up to this one
    index: output for the row's position, from 0
    back: output for the row's position from the end, from 1; needs `index`
    """
    previous = dict(previous or {})
    totals = dict(total or {})
    if index:
        totals[index] = F.lit(1).cast("bigint")
    from_end = [back] if back else []

    def plain(rows: DataFrame) -> DataFrame:
        along = W.partitionBy(*keys).orderBy(*order)
        running = along.rowsBetween(W.unboundedPreceding, W.currentRow)
        sums = {out: F.sum(expr).over(running) for out, expr in totals.items()}
        if index:
            sums[index] = sums[index] - 1
        if back:
            sums[back] = F.count(F.lit(1)).over(W.partitionBy(*keys)) - sums[index]
        return rows.select(
            "*",
            *[F.lag(source).over(along).alias(out) for out, source in previous.items()],
            *[column.alias(out) for out, column in sums.items()],
        )

    def chunked(rows: DataFrame) -> DataFrame:
        scanned = _chunked_scan(rows, keys, order, previous, totals, index, back)
        return scanned.select(*df.columns, *previous, *totals, *from_end)

    return _by_size(df, keys, order, max_rows, chunk_rows, plain, chunked)


def _chunked_scan(rows, keys, order, previous, totals, index, back) -> DataFrame:
    position = F.struct(*[F.col(name) for name in order])
    # A struct around the value: the last row counts even where its value is null.
    parts = [F.max_by(F.struct(F.col(source).alias("v")), position).alias(f"_last_{out}") for out, source in previous.items()]
    parts += [F.sum(expr).alias(f"_sum_{out}") for out, expr in totals.items()]
    chunks = rows.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_rows"), *parts)

    along = W.partitionBy(*keys).orderBy("_chunk")
    before = along.rowsBetween(W.unboundedPreceding, -1)
    carried = chunks.select(
        *keys,
        "_chunk",
        *[F.lag(f"_last_{out}").over(along)["v"].alias(f"_carry_{out}") for out in previous],
        *[F.sum(f"_sum_{out}").over(before).alias(f"_carry_{out}") for out in totals],
        F.sum("_rows").over(W.partitionBy(*keys)).alias("_all"),
    )

    inside = W.partitionBy(*keys, "_chunk").orderBy(*order)
    running = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    scanned = rows.withColumns({
        "_first": F.row_number().over(inside) == 1,
        **{f"_in_{out}": F.lag(source).over(inside) for out, source in previous.items()},
        **{f"_in_{out}": F.sum(expr).over(running) for out, expr in totals.items()},
    })

    joined = scanned.alias("_d").join(carried.alias("_c"), _same("_d", "_c", [*keys, "_chunk"]))
    result = {
        out: F.when(F.col("_d._first"), F.col(f"_c._carry_{out}")).otherwise(F.col(f"_d._in_{out}"))
        for out in previous
    }
    for out in totals:
        here, earlier = F.col(f"_d._in_{out}"), F.col(f"_c._carry_{out}")
        # A sum over nulls only is null, as in a plain window.
        value = F.when(here.isNull(), earlier).otherwise(here + F.coalesce(earlier, F.lit(0)))
        result[out] = value - 1 if out == index else value
    if back:
        result[back] = F.col("_c._all") - result[index]
    return joined.select("_d.*", *[column.alias(out) for out, column in result.items()])


def sessions(
    df: DataFrame,
    keys: Sequence[str],
    millis: str,
    gap_ms: int,
    out: str = "session_start",
    max_rows: int = MAX_ROWS_PER_KEY,
    chunk_rows: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Mark every row with the first instant of its session.

    A session ends when nothing follows within `gap_ms`; a row exactly `gap_ms`
    later still belongs to it. A row without time belongs to none.
    """

    def plain(rows: DataFrame) -> DataFrame:
        return _opened(rows, keys, millis, gap_ms, out)

    def chunked(rows: DataFrame) -> DataFrame:
        return _chunked_sessions(rows, keys, millis, gap_ms, out).select(*df.columns, out)

    return _by_size(df, keys, [millis], max_rows, chunk_rows, plain, chunked)


def _opened(rows: DataFrame, keys, millis: str, gap_ms: int, out: str) -> DataFrame:
    """Add the instant since which no gap was found."""
    along = W.partitionBy(*keys).orderBy(millis)
    running = along.rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("_prev", F.lag(millis).over(along))
    opens = F.col("_prev").isNull() | (F.col(millis) - F.col("_prev") > gap_ms)
    return rows.withColumn(out, F.max(F.when(opens, F.col(millis))).over(running)).drop("_prev")


def _chunked_sessions(rows, keys, millis, gap_ms, out) -> DataFrame:
    """Sessions are found inside each chunk first. Only a chunk's first one can go on from
    an earlier chunk, so one row per chunk is joined up along the key."""
    rows = _opened(rows, [*keys, "_chunk"], millis, gap_ms, "_open")
    chunks = rows.groupBy(*keys, "_chunk").agg(
        F.min(millis).alias("_first"), F.max(millis).alias("_end"), F.max("_open").alias("_last")
    )
    along = W.partitionBy(*keys).orderBy("_chunk")
    before = along.rowsBetween(W.unboundedPreceding, -1)
    chunks = chunks.withColumn(
        "_goes_on", F.coalesce(F.col("_first") - F.max("_end").over(before) <= gap_ms, F.lit(False))
    )
    # Where the session at a chunk's end began, unless the chunk only continues an earlier one.
    began = F.when(F.col("_last") > F.col("_first"), F.col("_last")).when(~F.col("_goes_on"), F.col("_first"))
    chunks = chunks.withColumn("_began", began)
    chunks = chunks.withColumn(
        "_start", F.when(F.col("_goes_on"), F.last("_began", ignorenulls=True).over(before)).otherwise(F.col("_first"))
    )
    joined = rows.alias("_d").join(chunks.alias("_c"), _same("_d", "_c", [*keys, "_chunk"]))
    start = F.when(F.col("_d._open") == F.col("_c._first"), F.col("_c._start")).otherwise(F.col("_d._open"))
    return joined.select("_d.*", start.alias(out))


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row with the greatest `order` per key; duplicates shrink before the shuffle."""
    columns = [name for name in df.columns if name not in keys]
    packed = F.struct(*[F.col(name) for name in columns])
    best = df.groupBy(*keys).agg(F.max_by(packed, F.struct(*order)).alias("_row"))
    return best.select(*[F.col(name) if name in keys else F.col(f"_row.{name}") for name in df.columns])


def top(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first `n` rows per key by `order`, numbered from 1.

    Spark drops rows that cannot be among the first `n` in each input task already,
    so a large key sends few rows through the shuffle.
    """
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)
