"""Avro records. Spark's Avro module is a separate jar; these need it.

Records are declared as their writers declare them, with enums, and brought to the layout after reading. Without the
jar only the declarations are tested, field by field.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell import schemas
from tidewell.schemas import AvroContract


def read_avro(spark: SparkSession, path: str, contract: AvroContract) -> DataFrame:
    """Avro files of a contract, in its layout. Files carry their own writer's declaration."""
    return schemas.conform(spark.read.format("avro").load(path), contract.layout)


def decode_avro(records: DataFrame, contract: AvroContract) -> DataFrame:
    """Topic records with Avro values, in the layout of the contract."""
    from pyspark.sql.avro.functions import from_avro

    declared = json.dumps(schemas.avro_record(contract))
    decoded = records.select(from_avro(F.col("value"), declared).alias("_event")).select("_event.*")
    return schemas.conform(decoded, contract.layout)
