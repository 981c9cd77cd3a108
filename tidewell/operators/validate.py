"""Event validation and the counts that go with it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell import config


def has_required(fields: Column | None = None, event_type: str = "event_type") -> Column:
    """True when the type is known and all its required fields are there.

    With `fields`, an array of the keys a JSON event has, a field that is present but
    null counts as there. Without it a field is there when it is not null.
    """
    kind = F.col(event_type)
    chain = F
    for name, needed in config.REQUIRED_FIELDS.items():
        ok = F.lit(True)
        for field in needed:
            ok = ok & (F.array_contains(fields, field) if fields is not None else F.col(field).isNotNull())
        chain = chain.when(kind == name, ok)
    return F.coalesce(chain.otherwise(F.lit(False)), F.lit(False))


def validate(events: DataFrame, fields: str | None = None) -> DataFrame:
    """Add `valid`. `fields` names the array of present keys, where there is one.

    An event with a value of a wrong type, listed in `misfits`, is not valid.
    """
    ok = has_required(F.col(fields) if fields else None)
    if "misfits" in events.columns:
        ok = ok & (F.coalesce(F.size("misfits"), F.lit(0)) == 0)
    return events.withColumn("valid", ok)


def route_valid_invalid(events: DataFrame, fields: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Accepted events, and the dead letters."""
    flagged = validate(events, fields)
    return flagged.filter("valid").drop("valid"), flagged.filter(~F.col("valid")).drop("valid")


def consumer_stats(validated: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Accepted and rejected messages per topic and partition."""
    return validated.groupBy(*(by or ["topic", "partition"])).agg(
        F.count_if(F.col("valid")).alias("consumed"),
        F.count_if(~F.col("valid")).alias("invalid"),
    )
