"""Sources, validation, normalising."""

import json
import os
import uuid

import pytest

from tests.conftest import rows
from tidewell import config, schemas
from tidewell.config import FraudConfig
from tidewell.operators import fraud, quality, validate
from tidewell.plans import batch
from tidewell.sources import avro, clickstream, tables, topics
from tidewell.storage import new_path, scratch, shared_dir, write_once


def records(spark, values):
    return spark.createDataFrame(
        [(v, "raw-events", 0, i) for i, v in enumerate(values)], "value string, topic string, partition int, offset bigint"
    )


def checked(spark, values):
    parsed = topics.parse_json(records(spark, values), schemas.EVENT)
    return {r.offset: r.valid for r in validate.validate(parsed, "fields").collect()}


VIEW = {"event_id": "test-event-123", "event_type": "view", "timestamp": 1704067200000, "user_id": "12345",
        "session_id": "session-abc", "item_id": "9876", "category": "Electronics", "device_type": "desktop"}
BUY = {"event_id": "test-event-456", "event_type": "transaction", "timestamp": 1704067200000, "user_id": "12345",
       "item_id": "9876", "category": "Electronics", "price": 599.99, "quantity": 2, "device_type": "mobile"}


def test_validation(spark):
    values = [
        VIEW, BUY, {"event_id": "test-invalid", "timestamp": 1704067200000}, {"user_id": "1", "timestamp": 5},
        {"event_type": "view", "user_id": "123"}, {"event_type": "unknown", "user_id": "123"},
        {**VIEW, "item_id": None},
    ]
    got = checked(spark, [json.dumps(v) for v in values] + ["{broken", "[1]"])
    # A required field that is there but null passes.
    assert got == {0: True, 1: True, 2: False, 3: False, 4: False, 5: False, 6: True, 7: False, 8: False}


def test_decoded_fields(spark):
    row = topics.parse_json(records(spark, [json.dumps(BUY)]), schemas.EVENT).first()
    assert row.parsed and row.price == 599.99 and row.quantity == 2 and row.timestamp == 1704067200000
    assert row.topic == "raw-events" and row.partition == 0


def test_consumer_stats(spark):
    parsed = topics.parse_json(records(spark, [json.dumps(VIEW), "{no", json.dumps(BUY)]), schemas.EVENT)
    assert rows(validate.consumer_stats(validate.validate(parsed, "fields"))) == [
        {"topic": "raw-events", "partition": 0, "consumed": 2, "invalid": 1}
    ]


def test_sending(spark):
    events = spark.createDataFrame(
        [("12345", "view"), (None, "view"), ("7", None)], "user_id string, event_type string"
    )
    sent = topics.to_records(topics.sendable(events), "raw-events").collect()
    assert [(r.topic, r.key, json.loads(r.value)) for r in sent] == [
        ("raw-events", "12345", {"user_id": "12345", "event_type": "view"})
    ]


def test_topics():
    assert topics.resolve_topics(["events", "nothing"]) == ["raw-events"]
    assert topics.resolve_topics() == ["raw-events"]
    with pytest.raises(ValueError):
        topics.resolve_topics(["nothing"])
    options = topics.kafka_options("b:9092", ["events", "inventory"], "g", 1700000000000)
    assert options["subscribe"] == "raw-events,inventory-changes"
    assert options["startingTimestamp"] == "1700000000000" and "startingOffsets" not in options
    assert topics.kafka_options("b:9092", starting="earliest")["startingOffsets"] == "earliest"


def test_unknown_alias_is_rejected(spark):
    df = spark.createDataFrame([("events",), ("other",)], "alias string")
    assert [r.topic for r in topics.route(df).collect()] == ["raw-events"]


def test_retention_and_compaction(spark):
    day = 86400000
    df = spark.createDataFrame(
        [("recommendations", "a", 10 * day), ("recommendations", "a", 9 * day), ("recommendations", "b", 8 * day),
         ("raw-events", "c", 3 * day), ("raw-events", "c", 10 * day), ("raw-events", "c", 2 * day), ("other", "d", 1)],
        "topic string, key string, timestamp_ms bigint",
    )
    kept = sorted((r.topic, r.timestamp_ms // day) for r in topics.retained(df).collect())
    assert kept == [("other", 0), ("raw-events", 3), ("raw-events", 10), ("recommendations", 9), ("recommendations", 10)]
    newest = topics.compacted(df, ["key"], ["timestamp_ms"])
    assert {r.key: r.timestamp_ms // day for r in newest.collect()} == {"a": 10, "b": 8, "c": 10, "d": 0}
    assert topics.replay_from(df, 9 * day).count() == 3 and topics.replay_from(df).count() == 7


CSV = """Timestamp,VisitorID,Event,ItemID,TransactionID,Price,Quantity
1433221332,257597,view,355908,,,
1433221333,1,transaction,10,4000,12.5,2
1433221334,2,addtocart,11,4000,,
1433221335,3,VIEW,12,,abc,2.5
1433221336,4,search,13,,,
1433221337,,view,14,,,
1433221338,5,view,,,,
,6,view,15,,,
abc,7,view,16,,,
"""


def csv_file(text):
    import tempfile

    path = os.path.join(tempfile.mkdtemp(prefix="tidewell-csv-"), "clicks.csv")
    with open(path, "w") as out:
        out.write(text)
    return path


@pytest.mark.parametrize("header", ["as is", "lower"])
def test_clickstream(spark, header):
    text = CSV if header == "as is" else CSV.split("\n", 1)[0].lower() + "\n" + CSV.split("\n", 1)[1]
    scanned = clickstream.scan_csv(spark, csv_file(text))
    assert scanned.count() == 9
    got = {r.event_id: r for r in clickstream.load(scanned).collect()}
    assert set(got) == {"rr-1433221332-257597", "rr-1433221333-1", "rr-1433221334-2", "rr-1433221335-3"}
    assert got["rr-1433221332-257597"].timestamp == 1433221332000 and got["rr-1433221332-257597"].price is None
    buy = got["rr-1433221333-1"]
    assert (buy.transaction_id, buy.price, buy.quantity) == ("4000", 12.5, 2)
    assert got["rr-1433221334-2"].transaction_id is None
    odd = got["rr-1433221335-3"]
    assert (odd.event_type, odd.price, odd.quantity) == ("view", None, None)
    stats = clickstream.load_stats(clickstream.normalize(scanned)).first()
    assert (stats.events, stats.errors, stats.total) == (4, 5, 9)


def test_raw_normalizer(spark):
    scanned = clickstream.scan_csv(spark, csv_file("timestamp,visitorid,event,itemid,transactionid\n5,1,View,,\n6,,transaction,2,t1\nx,1,view,1,\n"))
    got = clickstream.load(scanned, clickstream.normalize_raw)
    assert rows(got) == [
        {"event_id": "rr-5-1", "event_type": "view", "timestamp": 5, "user_id": "1", "item_id": "", "transaction_id": None},
        {"event_id": "rr-6-", "event_type": "transaction", "timestamp": 6, "user_id": "", "item_id": "2", "transaction_id": "t1"},
    ]


def test_limits(spark):
    scanned = clickstream.scan_csv(spark, csv_file(CSV))
    order = ["Timestamp"]
    present = scanned.filter("Timestamp is not null")
    assert clickstream.load(present, max_raw=5, order=order).count() == 4
    assert clickstream.load(present, max_raw=0, order=order).count() == 4
    assert clickstream.load(present, max_valid=3, order=["timestamp"]).count() == 3


def test_missing_file(spark):
    assert clickstream.scan_csv(spark, "/nowhere/at/all.csv").count() == 0


def test_basic_features(spark):
    schema = "user_id string, event_type string, timestamp bigint, price string, quantity string"
    df = spark.createDataFrame([("user123", "transaction", 1234567890, "99.99", "2"), (None, None, None, None, None),
                                ("u", "view", 1, "abc", "1"), ("u", "view", 1, "1", "2.5")], schema)
    assert rows(fraud.basic_features(df)) == [
        {"user_id": "unknown", "event_type": "unknown", "timestamp": 0, "amount": 0.0, "quantity": 1},
        {"user_id": "user123", "event_type": "transaction", "timestamp": 1234567890, "amount": 99.99, "quantity": 2},
    ]


def test_clamp(spark):
    df = spark.createDataFrame([(150.0, 5, True, "u"), (-100.0, 1000, False, "v"), (float("nan"), 0, True, "w")],
                               "amount double, velocity int, flag boolean, user_id string")
    got = {r.user_id: (r.amount, r.velocity, r.flag) for r in fraud.normalize(df).collect()}
    assert got == {"u": (1.0, 1.0, 1.0), "v": (0.0, 1.0, 0.0), "w": (0.0, 0.0, 1.0)}


def test_avro_records_match_their_contracts():
    event, change = schemas.avro_record(schemas.EVENT_CONTRACT), schemas.avro_record(schemas.INVENTORY_CONTRACT)
    kinds = {f["name"]: f["type"] for f in event["fields"]}
    assert [f["name"] for f in event["fields"]] == [
        "event_id", "event_type", "timestamp", "user_id", "session_id", "item_id", "category", "price", "quantity", "search_query",
        "filter_type", "filter_value", "rating", "review_text", "device_type", "ip_address", "user_agent", "metadata",
    ]
    assert kinds["event_type"] == {
        "type": "enum", "name": "EventType", "symbols": ["view", "addtocart", "transaction", "search", "filter", "review"]
    }
    assert (kinds["timestamp"], kinds["price"], kinds["quantity"]) == ("long", ["null", "double"], ["null", "int"])
    assert kinds["metadata"] == ["null", {"type": "map", "values": "string"}]
    assert all(f["default"] is None for f in event["fields"] if isinstance(f["type"], list))
    kinds = {f["name"]: f["type"] for f in change["fields"]}
    assert kinds["change_type"]["symbols"] == ["stock_in", "stock_out", "adjustment", "reservation", "release"]
    assert (kinds["quantity_before"], kinds["warehouse_id"], kinds["unit_cost"]) == ("int", ["null", "string"], ["null", "double"])
    assert (event["namespace"], change["name"]) == ("com.ecommerce.events", "InventoryChange")
    assert callable(avro.read_avro) and callable(avro.decode_avro)


def test_csv_quotes_and_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Timestamp,VisitorID,Event\n1,"a ""b"" c",view\n2,"line\nbreak",view\n')
    got = clickstream.scan_csv(spark, str(tmp_path / "a.csv")).collect()
    assert [r["VisitorID"] for r in got] == ['a "b" c', "line\nbreak"]
    (tmp_path / "b.csv").write_text("VisitorID,Timestamp,Event\nu,3,view\n")
    with pytest.raises(Exception, match="header|schema"):
        clickstream.scan_csv(spark, str(tmp_path)).collect()


def test_out_of_range_numbers_do_not_end_the_load(spark):
    rows = spark.createDataFrame(
        [("1", "u", "view", "i", "99999999999"), ("99999999999999999", "u", "view", "i", "1"), ("2", "u", "view", "i", "3")],
        "Timestamp string, VisitorID string, Event string, ItemID string, Quantity string",
    )
    got = clickstream.normalize(rows).collect()
    assert [(r.valid, r.timestamp, r.quantity) for r in got] == [(True, 1000, None), (False, None, 1), (True, 2000, 3)]


def test_json_numbers_as_text_and_misfits(spark):
    values = [
        '{"event_id":"e","event_type":"view","timestamp":"1704067200000","user_id":"u","item_id":"i","price":"12.5","quantity":2}',
        '{"event_id":"e","event_type":"view","timestamp":1,"user_id":"u","item_id":"i","price":"cheap","quantity":2.5}',
        '{"event_id":"e","event_type":"view","timestamp":1,"user_id":"u","item_id":"i","price":null}', "no json",
    ]
    records = spark.createDataFrame([(v.encode(),) for v in values], "value binary")
    checked = validate.validate(topics.parse_json(records, schemas.EVENT), "fields").collect()
    assert [(r.parsed, r.timestamp, r.price, r.quantity, r.misfits, r.valid) for r in checked] == [
        (True, 1704067200000, 12.5, 2, [], True), (True, 1, None, None, ["price", "quantity"], False),
        (True, 1, None, None, [], True), (False, None, None, None, [], False),
    ]


def test_records_keep_null_fields(spark):
    sent = topics.to_records(spark.createDataFrame([("u", None)], "user_id string, price double"), "t").first()
    assert sent.value == '{"user_id":"u","price":null}'


def test_profile_extremes_are_typed(spark):
    found = quality.profile(spark.createDataFrame([(2.5,), (10.0,), (None,)], "price double"), ["price"]).first()
    assert (found.min_value, found.max_value, found.total, found.nulls) == ("2.5", "10.0", 3, 1)


def test_large_amounts_are_fraud(spark):
    events = spark.createDataFrame([(20000.0, 1.0)], "amount double, events_5m double")
    assert batch.score_fraud(events, ["amount"], FraudConfig(min_features=1)).first().is_fraud



def test_inventory_names(spark):
    avro_like = spark.createDataFrame([("i", 5)], "item_id string, quantity_after int")
    dbt_like = spark.createDataFrame([("i", 5.0)], "product_id string, current_stock double")
    for df in (avro_like, dbt_like):
        assert rows(schemas.inventory_view(df)) == [{"item_id": "i", "current_stock": 5.0}]


def test_overwrite_and_day_partitions(spark):
    path = new_path(spark, "days")
    df = spark.sql("select id, date_add(date'2024-01-01', cast(id % 3 as int)) as day from range(30)")
    tables.overwrite_path(df, path, "day")
    tables.overwrite_path(df, path, "day")
    one = tables.read_table(spark, path, "parquet").filter("day = date'2024-01-02'")
    assert one.count() == 10
    assert "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().executedPlan().toString()


def test_profile_and_checks(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2)], "k string, v int")
    assert rows(quality.duplicates(df.filter("k is not null"), "k")) == [{"k": "a", "cnt": 2}]
    assert quality.null_rows(df, ["k", "v"]).first().cnt == 2
    assert quality.null_rows(df.filter("k = 'a' and v = 1"), ["k"]).count() == 0
    profile = {r.column_name: (r.total, r.nulls, r.distinct_values) for r in quality.profile(df, ["k", "v"]).collect()}
    assert profile == {"k": (3, 1, 1), "v": (3, 1, 2)}


def test_shared_dir_is_required_on_a_cluster(spark):
    assert shared_dir(spark)
    assert set(config.REQUIRED_FIELDS) == set(config.EVENT_TYPES)


def test_scratch_tables_are_deleted(spark):
    df = spark.range(3)
    kept = write_once(df, "kept")
    with scratch(spark):
        gone = write_once(df, "gone")
        assert gone.count() == 3
        path = gone.inputFiles()[0].removeprefix("file:")
    assert not os.path.exists(os.path.dirname(path)) and kept.count() == 3


def test_days_not_written_stay(spark):
    path = new_path(spark, "days")
    first = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "n int, day string")
    tables.overwrite_path(first, path, "day")
    tables.overwrite_path(spark.createDataFrame([(3, "2024-01-02")], "n int, day string"), path, "day")
    assert sorted((r.n, str(r.day)) for r in spark.read.parquet(path).collect()) == [(1, "2024-01-01"), (3, "2024-01-02")]


def test_table_is_rebuilt_from_itself(spark):
    name = f"counted_{uuid.uuid4().hex}"
    tables.overwrite_table(spark.range(3), name)
    tables.overwrite_table(tables.read_table(spark, name).selectExpr("id + 1 AS id"), name)
    assert sorted(r.id for r in spark.table(name).collect()) == [1, 2, 3]
    spark.sql(f"DROP TABLE {name}")
