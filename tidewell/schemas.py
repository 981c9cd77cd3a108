"""Record layouts of the topics, the clickstream files and the caches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("timestamp", T.LongType(), False),
    T.StructField("user_id", T.StringType(), False),
    T.StructField("session_id", T.StringType()),
    T.StructField("item_id", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("search_query", T.StringType()),
    T.StructField("filter_type", T.StringType()),
    T.StructField("filter_value", T.StringType()),
    T.StructField("rating", T.IntegerType()),
    T.StructField("review_text", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("ip_address", T.StringType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    # Not part of the declared record, but both clickstream loaders add it.
    T.StructField("transaction_id", T.StringType()),
])

INVENTORY_CHANGE = T.StructType([
    T.StructField("change_id", T.StringType(), False),
    T.StructField("timestamp", T.LongType(), False),
    T.StructField("item_id", T.StringType(), False),
    T.StructField("warehouse_id", T.StringType()),
    T.StructField("change_type", T.StringType(), False),
    T.StructField("quantity_before", T.IntegerType(), False),
    T.StructField("quantity_change", T.IntegerType(), False),
    T.StructField("quantity_after", T.IntegerType(), False),
    T.StructField("reason", T.StringType()),
    T.StructField("reference_id", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("unit_cost", T.DoubleType()),
    T.StructField("location", T.StringType()),
    T.StructField("operator_id", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])

# What a Kafka source hands over, and what the file stand-in for one holds.
TOPIC_RECORD = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

CLICKSTREAM_CSV = T.StructType([
    T.StructField(name, T.StringType())
    for name in ["Timestamp", "VisitorID", "Event", "ItemID", "TransactionID", "Price", "Quantity"]
])

CACHE_ENTRY = T.StructType([
    T.StructField("key", T.StringType(), False),
    T.StructField("value", T.StringType()),
    T.StructField("written_at", T.TimestampType()),
    T.StructField("expires_at", T.TimestampType()),
])

_AVRO_TYPES = {
    T.StringType(): "string",
    T.LongType(): "long",
    T.IntegerType(): "int",
    T.DoubleType(): "double",
}


@dataclass(frozen=True)
class AvroContract:
    """How a layout is declared as an Avro record by those who write it."""

    layout: T.StructType
    name: str
    namespace: str
    enums: dict[str, tuple[str, tuple[str, ...]]]
    absent: frozenset[str] = frozenset()


# Names and symbols of the two record contracts; fixed values.
EVENT_CONTRACT = AvroContract(
    EVENT, "EcommerceEvent", "com.ecommerce.events",
    {"event_type": ("EventType", ("view", "addtocart", "transaction", "search", "filter", "review"))},
    frozenset({"transaction_id"}),
)
INVENTORY_CONTRACT = AvroContract(
    INVENTORY_CHANGE, "InventoryChange", "com.ecommerce.inventory",
    {"change_type": ("ChangeType", ("stock_in", "stock_out", "adjustment", "reservation", "release"))},
)


def avro_record(contract: AvroContract) -> dict:
    """The Avro declaration records are written with: for `from_avro`, which needs the writer's, and a registry."""
    fields = []
    for item in contract.layout.fields:
        if item.name in contract.absent:
            continue
        if item.name in contract.enums:
            name, symbols = contract.enums[item.name]
            kind: object = {"type": "enum", "name": name, "symbols": list(symbols)}
        elif isinstance(item.dataType, T.MapType):
            kind = {"type": "map", "values": "string"}
        else:
            kind = _AVRO_TYPES[item.dataType]
        if item.nullable:
            fields.append({"name": item.name, "type": ["null", kind], "default": None})
        else:
            fields.append({"name": item.name, "type": kind})
    return {"type": "record", "name": contract.name, "namespace": contract.namespace, "fields": fields}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give `df` exactly the columns of `schema`; what is missing becomes null."""
    have = set(df.columns)
    return df.select([
        (F.col(item.name) if item.name in have else F.lit(None)).cast(item.dataType).alias(item.name)
        for item in schema.fields
    ])


def inventory_view(df: DataFrame) -> DataFrame:
    """Bring the three spellings of product and stock columns to one."""
    have = set(df.columns)

    def first_of(*names: str):
        found = [F.col(name) for name in names if name in have]
        return F.coalesce(*found) if found else F.lit(None)

    return df.withColumns({
        "item_id": first_of("item_id", "product_id").cast("string"),
        "current_stock": first_of("current_stock", "quantity_after").cast("double"),
    }).drop("product_id", "quantity_after")
