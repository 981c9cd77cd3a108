"""Exact duplicates by a tree-merge of sorted digest runs.

Every scan partition is a run: it is sorted by digest, and equal neighbours are folded into one row with the
identifier that stays and the number of rows. Runs then meet in rounds. In each, `fan_in` neighbours exchange what
they have: each takes one part of the digests' range from all of them, merges the sorted pieces and folds equal
neighbours again. After the last round all runs have met and every part of the range is one sorted run; no task ever
holds more than its part. A digest held by a third of all rows is one row per run from the first fold on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUNS = 4096
FAN_IN = 16
KEY = ["sha", "short", "bytes"]


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, sha (hex SHA-256 of the UTF-8 text, null as empty), short (XXH64) and bytes of each row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"),
        F.sha2(text, 256).alias("sha"),
        F.xxhash64(text).alias("short"),
        F.octet_length(text).alias("bytes"),
    )


def _stays(column: Column, keep: str) -> Column:
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be smallest or largest, not {keep}")
    return F.min(column) if keep == "smallest" else F.max(column)


def _folded(runs: DataFrame, place: list[str], keep: str) -> DataFrame:
    """Runs brought together by `place`, merged in the order of their digests, with equal neighbours folded.

    The identifier is compared inside a struct, which Spark aggregates in sorted order, row after row, and not by
    hashing. A null one counts only where there is no other.
    """
    merged = runs.repartition(*place).sortWithinPartitions(*place, *KEY)
    known = F.when(F.col("keep_id").isNotNull(), F.struct("keep_id"))
    folded = merged.groupBy(*place, *KEY).agg(_stays(known, keep).alias("_id"), F.sum("group_size").alias("group_size"))
    return folded.select(*place, *KEY, F.col("_id.keep_id").alias("keep_id"), "group_size")


def merge_runs(rows: DataFrame, keep: str = "smallest", runs: int = RUNS, fan_in: int = FAN_IN) -> DataFrame:
    """One row per distinct text: short, sha, bytes, keep_id and group_size.

    `rows` as from `digests`. Two rows are equal when both digests and the length agree; this
    is checked anew at every level, the short digest alone never decides.
    """
    level = rows.select(
        *KEY, F.pmod(F.spark_partition_id(), F.lit(runs)).alias("run"), F.col("id").alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
    )
    level = _folded(level, ["run"], keep).withColumn("part", F.lit(0).cast("bigint"))
    parts = 1
    # The first 32 bits of the digest, as a place in its range.
    top = F.conv(F.substring("sha", 1, 8), 16, 10).cast("bigint")
    while runs > 1:
        runs, parts = -(-runs // fan_in), parts * fan_in
        level = level.withColumns({
            "run": F.floor(F.col("run") / fan_in).cast("int"),
            "part": F.shiftright(top * F.lit(parts).cast("bigint"), 32),
        })
        level = _folded(level, ["run", "part"], keep)
    return level.drop("run", "part")


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    runs: int = RUNS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """One row per row of `docs`: its id, keep_id, group_size, kept and text_sha256.

    A null text counts as empty, and all empty texts are equal. A null id stays only where its
    whole group has none. Rows that repeat an id and its text share one decision and each count
    in group_size. An empty table gives an empty result; other columns are not read.
    """
    rows = digests(docs, id_col, text_col)
    groups = merge_runs(rows, keep, runs, fan_in)
    # A text that occurs once needs nothing from the tree, so only repeated ones are joined.
    repeated = groups.filter("group_size > 1").select("short", "sha", "bytes", "keep_id", "group_size")
    keep_id = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return (
        rows.join(repeated, ["short", "sha", "bytes"], "left")
        .select(
            F.col("id").alias(id_col),
            keep_id.alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
            F.col("id").eqNullSafe(keep_id).alias("kept"),
            F.col("sha").alias("text_sha256"),
        )
    )


def drop_exact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of `docs` that stay, with all their columns.

    Rows that repeat an id and its text are one document and stay or go together.
    """
    repeated = merge_runs(digests(docs, id_col, text_col), keep).filter("group_size > 1").alias("_g")
    text = F.coalesce(F.col(f"_d.`{text_col}`"), F.lit(""))
    same = (
        (F.xxhash64(text) == F.col("_g.short"))
        & (F.sha2(text, 256) == F.col("_g.sha"))
        & (F.octet_length(text) == F.col("_g.bytes"))
    )
    stays = F.col("_g.sha").isNull() | F.col(f"_d.`{id_col}`").eqNullSafe(F.col("_g.keep_id"))
    return docs.alias("_d").join(repeated, same, "left").filter(stays).select("_d.*")
