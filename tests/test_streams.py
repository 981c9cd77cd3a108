"""Streams over several micro-batches give what batch gives."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewell import schemas
from tidewell.catalogue.tables import Tables
from tidewell.operators import cache, metrics, profiles, series, similarity, stock, windows
from tidewell.sources import topics
from tidewell.sources.keyed import KeyedTable
from tidewell.storage import folders, new_path
from tidewell.streaming import jobs, sinks

HOUR = 3600000
FAR = 40 * 24 * HOUR


def make_events(spark, n=300, seed=4):
    rnd = random.Random(seed)
    data, now = [], 0
    for i in range(n):
        now += rnd.choice([1000, 60000, 200000, 900000])
        kind = rnd.choice(["view", "addtocart", "transaction"])
        data.append((f"e{i:04d}", f"u{rnd.randrange(4)}", f"i{rnd.randrange(6)}", kind, float(rnd.randrange(1, 50)), 1, now))
    schema = "event_id string, user_id string, item_id string, event_type string, price double, quantity int, timestamp bigint"
    return spark.createDataFrame(data, schema)


def deliver(spark, path, events, parts=1):
    """Append records in `parts` files, in time order, one after the other."""
    span = events.agg(F.min("timestamp").alias("a"), (F.max("timestamp") + 1).alias("b")).first()
    for n in range(parts):
        low, high = (span.a + (span.b - span.a) * k // parts for k in (n, n + 1))
        part = events.filter((F.col("timestamp") >= low) & (F.col("timestamp") < high))
        Tables._records(part, "raw-events", F.col("user_id")).coalesce(1).write.mode("append").parquet(path)


def closing(spark):
    return spark.createDataFrame(
        [("zz", "zz", "zz", "view", 0.0, 1, FAR)],
        "event_id string, user_id string, item_id string, event_type string, price double, quantity int, timestamp bigint",
    )


def run_in_steps(spark, events, build, parts=4):
    """Deliver a part, run the stream to its end, and again; the checkpoint carries on."""
    path, out, checkpoint = (new_path(spark, name) for name in ("in", "out", "checkpoint"))
    span = events.agg(F.min("timestamp").alias("a"), (F.max("timestamp") + 1).alias("b")).first()
    schema = None
    for n in range(parts):
        low, high = (span.a + (span.b - span.a) * k // parts for k in (n, n + 1))
        part = events.filter((F.col("timestamp") >= low) & (F.col("timestamp") < high))
        if n == parts - 1:
            part = part.unionByName(closing(spark))
        deliver(spark, path, part)
        stream = build(jobs.events_of(topics.read_topic_files_stream(spark, path, files_per_trigger=1)))
        schema = stream.schema
        sinks.start(sinks.append_files(stream, out), checkpoint, available_now=True)
    return spark.read.schema(schema).parquet(out)


def same(a, b):
    a, b = a.select(*sorted(a.columns)), b.select(*sorted(b.columns))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_tumbling(spark):
    events = make_events(spark)
    got = run_in_steps(spark, events, windows.tumbling).filter("user_id <> 'zz'")
    same(got, windows.tumbling(windows.event_time(events)))


def test_sessions(spark):
    events = make_events(spark)
    got = run_in_steps(spark, events, windows.stream_sessions).filter("user_id <> 'zz'")
    same(got, windows.stream_sessions(windows.event_time(events)))
    chunked = profiles.session_features(profiles.user_sessions(events, max_rows=10), ["user_id", "session_start"])
    same(got.withColumn("session_start", F.unix_millis("session_start")), chunked.drop("is_empty"))


def test_late_rows_are_dropped_counted_and_kept(spark):
    path, out, checkpoint = (new_path(spark, name) for name in ("in", "out", "checkpoint"))
    kept, kept_checkpoint = new_path(spark, "late"), new_path(spark, "late-checkpoint")
    events = make_events(spark, 50)
    deliver(spark, path, events.unionByName(closing(spark)))
    listener = sinks.StreamMetrics()
    spark.streams.addListener(listener)

    def run():
        stream = jobs.events_of(topics.read_topic_files_stream(spark, path))
        sinks.start(jobs.late_job(stream, kept), kept_checkpoint, available_now=True)
        result = windows.tumbling(stream)
        return sinks.start(sinks.append_files(result, out), checkpoint, available_now=True), stream.schema, result.schema

    try:
        run()
        late = events.filter("event_id in ('e0000', 'e0007')")
        deliver(spark, path, late)
        query, events_schema, schema = run()
        for _ in range(100):
            if listener.dropped(query):
                break
            time.sleep(0.1)
        assert listener.dropped(query) == 2
    finally:
        spark.streams.removeListener(listener)
    same(spark.read.schema(schema).parquet(out).filter("user_id <> 'zz'"), windows.tumbling(windows.event_time(events)))
    late = sinks.read_batches(spark, f"{kept}/rows", events_schema).collect()
    assert sorted(r["event_id"] for r in late) == ["e0000", "e0007"]


def test_lag_of_a_stream_that_stopped(spark):
    path, done, checkpoint = (new_path(spark, name) for name in ("in", "out", "checkpoint"))
    offered = spark.createDataFrame(
        [("raw-events", p, o) for p in range(3) for o in range(10 * (p + 1))], "topic string, partition int, offset bigint"
    )
    records = schemas.conform(offered, schemas.TOPIC_RECORD)
    records.filter("partition < 2 and offset < 6").write.parquet(path)
    stream = topics.read_topic_files_stream(spark, path).select("topic", "partition", "offset")
    sinks.start(sinks.append_files(stream, done), checkpoint, available_now=True)
    processed = spark.read.schema(stream.schema).parquet(done)
    assert rows(metrics.consumer_lag(offered, processed, alarm=47)) == [
        {"topic": "raw-events", "offered": 60, "processed": 12, "lag": 48, "alarm": True}
    ]
    reported = {"endOffset": '{"raw-events":{"0":6,"1":4}}', "latestOffset": '{"raw-events":{"0":10,"1":4,"2":3}}'}
    assert sinks.source_lag(reported) == {("raw-events", "0"): 4, ("raw-events", "1"): 0, ("raw-events", "2"): 3}
    assert sinks.source_lag({"endOffset": None, "latestOffset": {"logOffset": 3}}) == {}


def test_keyed_table_over_many_batches(spark):
    shape = spark.createDataFrame([], "key string, value int, written_at timestamp, expires_at timestamp").schema
    table = KeyedTable(new_path(spark, "keyed"), shape, ("key",), ("written_at",), "expires_at", buckets=4, merge_after=4)
    stamp = lambda n: F.timestamp_millis(F.lit(n * HOUR))
    want = {}
    for n in range(18):
        part = spark.createDataFrame([(f"k{i}", 100 * n + i) for i in range(n % 5, 12, 3)], "key string, value int")
        part = part.withColumns({"written_at": stamp(n), "expires_at": stamp(n + 6)})
        table.write(part, n, stamp(n))
        want |= {r["key"]: (r["value"], n) for r in part.collect()}
        if n in (5, 9):
            # A repeated micro-batch, whether it was merged meanwhile or not, changes nothing.
            table.write(part.withColumn("value", F.col("value")), n - n % 4, stamp(n)) if n == 9 else table.write(part, n, stamp(n))
        if n in (3, 11, 17):
            got = {r["key"]: r["value"] for r in table.read(spark, stamp(n)).collect()}
            assert got == {k: v for k, (v, at) in want.items() if at + 6 > n}
    deltas, versions = folders(spark, f"{table.path}/delta", "batch="), folders(spark, f"{table.path}/base", "version=")
    assert len(deltas) <= 2 * table.merge_after and len(versions) <= 3
    assert len(folders(spark, f"{table.path}/manifest", "version=")) <= 2
    requests = spark.createDataFrame([("k1",)], "key string")
    asked = table.asked(requests)
    assert len(asked) == 1
    some = table.read(spark, buckets=asked)
    assert {r["key"] for r in some.collect()} == {
        r["key"] for r in table.read(spark).collect() if table.asked(spark.createDataFrame([(r["key"],)], "key string")) == asked
    }
    assert len(some.inputFiles()) < len(table.read(spark).inputFiles())
    late = spark.createDataFrame([("k1", 9999)], "key string, value int").withColumns({"written_at": stamp(90), "expires_at": stamp(99)})
    table.write(late, 0)
    assert table.read(spark).filter("value = 9999").count() == 0


def test_keyed_table_whose_rows_all_expire(spark):
    shape = spark.createDataFrame([], "key string, written_at timestamp, expires_at timestamp").schema
    table = KeyedTable(new_path(spark, "keyed"), shape, ("key",), ("written_at",), "expires_at", buckets=2, merge_after=1)
    assert table.read(spark).count() == 0
    old = spark.createDataFrame([("a",), ("b",)], "key string").withColumns({"written_at": F.timestamp_millis(F.lit(0)), "expires_at": F.timestamp_millis(F.lit(1))})
    table.write(old, 0, F.timestamp_millis(F.lit(5)))
    assert table.read(spark).count() == 0
    table.write(old, 0)
    assert table.read(spark).count() == 0
    table.write(old, 1)
    assert table.read(spark).count() == 2


def test_idle_users_leave_the_state(spark):
    path, out, checkpoint = (new_path(spark, name) for name in ("in", "out", "checkpoint"))
    events = make_events(spark, 200)
    for part in (events, closing(spark)):
        deliver(spark, path, part)
        stream = jobs.events_of(topics.read_topic_files_stream(spark, path))
        sinks.start(jobs.activity_job(stream, out), checkpoint, available_now=True)
    days = jobs.activity_table(stream, out).read(spark)
    held = spark.read.format("statestore").load(checkpoint)
    state = [(r["user_id"], r["start"], *r["value"]) for r in held.select("key.user_id", "key.window.start", "value").collect()]
    # The state holds the last user's day only, and the same counts as the table does.
    assert state == [tuple(r) for r in days.filter("user_id = 'zz'").select("user_id", "day", *jobs.ACTIVITY).collect()]
    totals = {r["user_id"]: r["total_interactions"] for r in jobs.activity_totals(days).collect()}
    assert totals == {r["user_id"]: r["count"] for r in events.unionByName(closing(spark)).groupBy("user_id").count().collect()}


def test_bronze_takes_each_valid_event_once(spark):
    path, out, checkpoint = (new_path(spark, name) for name in ("in", "out", "checkpoint"))
    events = make_events(spark, 60)
    bad = events.limit(3).withColumns({"event_id": F.concat(F.lit("bad"), "event_id"), "item_id": F.lit(None).cast("string")})
    for part in (events, bad):
        deliver(spark, path, part)
        sinks.start(jobs.bronze_ingest(topics.read_topic_files_stream(spark, path), out), checkpoint, available_now=True)
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == [f"e{i:04d}" for i in range(60)]


def test_newest_copy_wins_whatever_the_order(spark):
    path, out, checkpoint = (new_path(spark, name) for name in ("in", "out", "checkpoint"))
    events = make_events(spark, 20)
    stamped = lambda version: events.withColumn("transaction_id", F.lit(version))
    schema = None
    for version in ("2", "1"):
        deliver(spark, path, stamped(version))
        stream = jobs.events_of(topics.read_topic_files_stream(spark, path)).select("event_id", "transaction_id")
        schema = stream.schema
        sinks.start(jobs.dedup_latest(stream, out, ["transaction_id"]), checkpoint, available_now=True)
    table = sinks.read_batches(spark, out, schema)
    assert table.count() == 40
    newest = sinks.latest_per_key(table, ["event_id"], ["transaction_id"])
    assert newest.count() == 20 and newest.filter("transaction_id = '2'").count() == 20


def test_repeated_batch_appears_once(spark):
    out = new_path(spark, "batches")
    write = sinks.batches_to(out)
    for batch_id in (0, 1, 1):
        write(spark.range(5), batch_id)
    assert sinks.read_batches(spark, out, spark.range(1).schema).count() == 10
    assert sinks.read_batches(spark, new_path(spark, "none"), spark.range(1).schema).count() == 0


def test_stock_in_steps(spark):
    rnd = random.Random(8)
    data = [(f"c{n:03d}", n * 6 * HOUR, f"i{n % 3}", "w", "stock_out", 0, -1, 300 - n - rnd.randrange(20)) for n in range(90)]
    schema = "change_id string, timestamp bigint, item_id string, warehouse_id string, change_type string, " \
             "quantity_before int, quantity_change int, quantity_after int"
    changes = spark.createDataFrame(data, schema)
    path, out, checkpoint = (new_path(spark, name) for name in ("in", "out", "checkpoint"))
    for half in (changes.filter("timestamp >= 972000000"), changes.filter("timestamp < 972000000")):
        Tables._records(half, "inventory-changes", F.col("item_id")).write.mode("append").parquet(path)
        stream = jobs.changes_of(topics.read_topic_files_stream(spark, path, ["inventory"]))
        sinks.start(jobs.stock_job(stream, out), checkpoint, available_now=True)
    got = jobs.stock_table(stream, out).read(spark).drop("key")
    # The late half has added to the sums.
    want = stock.full_alerts(stock.project_trend(stock.trend_sums(schemas.inventory_view(changes))))
    same(got, want)


def test_session_recommendations_wait_for_the_table(spark):
    events = make_events(spark, 120)
    sims = similarity.similarities(similarity.item_vectors(events))
    path, bronze, out, checkpoint = (new_path(spark, name) for name in ("in", "bronze", "out", "checkpoint"))
    deliver(spark, path, events.unionByName(closing(spark)))
    records = lambda: topics.read_topic_files_stream(spark, path)
    # An empty table first: the job has to fail, not to recommend from nothing.
    events.limit(0).select("event_id", "user_id", "item_id", "event_type", "timestamp", F.current_date().alias("event_date")) \
        .write.parquet(bronze)
    job = lambda: jobs.recommendation_job(jobs.events_of(records()), bronze, sims, out)
    with pytest.raises(Exception, match="behind"):
        sinks.start(job(), checkpoint, available_now=True)
    bronze = new_path(spark, "bronze")
    sinks.start(jobs.bronze_ingest(records(), bronze), new_path(spark, "bronze-checkpoint"), available_now=True)
    sinks.start(job(), checkpoint, available_now=True)
    got = spark.read.parquet(out).filter("user_id <> 'zz'")
    lengths = profiles.session_features(profiles.user_sessions(events), ["user_id", "session_start"])
    short = {(r.user_id, r.session_start) for r in lengths.filter("session_length < 3").collect()}
    cold = {tuple(r.session_id.split("-")) for r in got.filter("item_id like 'popular%'").collect()}
    assert {(u, int(s)) for u, s in cold} == short
    assert got.groupBy("session_id", "rank").count().filter("count > 1").count() == 0


def test_sessions_of_a_batch_are_not_broadcast(spark):
    bronze = new_path(spark, "bronze")
    stored = [(f"e{n}", "u", f"i{n % 3}", "view", n * HOUR // 2) for n in range(9)]
    spark.createDataFrame(stored, "event_id string, user_id string, item_id string, event_type string, timestamp bigint").withColumn(
        "event_date", F.to_date(F.timestamp_millis("timestamp"))
    ).write.parquet(bronze)
    sessions = spark.createDataFrame(
        [("a", "u", 0, HOUR, 3), ("b", "u", 2 * HOUR, 2 * HOUR + 1, 2), ("c", "v", 0, 0, 1)],
        "session_id string, user_id string, first_ms bigint, last_ms bigint, session_length bigint",
    )
    found = jobs.session_events(sessions, bronze)
    assert sorted((r["session_id"], r["event_id"]) for r in found.collect()) == [("a", "e0"), ("a", "e1"), ("a", "e2"), ("b", "e4")]
    missing = jobs.incomplete_sessions(sessions, found)
    assert sorted(r["session_id"] for r in missing.collect()) == ["b", "c"]
    for part in (found, missing):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_stream_settings_end_with_the_start(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    with sinks.stream_settings(spark):
        assert "RocksDB" in spark.conf.get(name)
    assert spark.conf.get(name, None) == before


def test_streams_keep_state_in_rocksdb(spark, tmp_path):
    given = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    given.write.parquet(str(tmp_path / "in"))
    counted = spark.readStream.schema(given.schema).parquet(str(tmp_path / "in")).groupBy("k").count()
    writer = counted.writeStream.outputMode("complete").format("memory").queryName("counted")
    query = sinks.start(writer, str(tmp_path / "checkpoint"), available_now=True)
    state = query.lastProgress["stateOperators"][0]
    assert any("rocksdb" in name for name in state["customMetrics"])


def test_lookup_of_stored_entries_reads_some_buckets(spark):
    table = cache.entry_table(new_path(spark, "cache"), merge_after=2)
    stamp = lambda n: F.timestamp_millis(F.lit(n * HOUR))
    for n in range(3):
        written = spark.createDataFrame([(f"k{i}", f"v{n}-{i}") for i in range(n, 40)], "key string, value string")
        table.write(written.withColumns({"written_at": stamp(n), "expires_at": stamp(n + 5)}), n, stamp(n))
    requests = spark.createDataFrame([("k0", 4), ("k0", 9), ("k7", 4), ("none", 4)], "key string, hour int").select(
        "key", F.timestamp_millis(F.col("hour") * HOUR).alias("requested_at")
    )
    found = cache.lookup_stored(requests, table)
    same(found, cache.lookup(requests, table.read(spark)))
    assert {(r["key"], r["value"], r["hit"], r["expired"]) for r in found.collect()} == {
        ("k0", "v0-0", True, False), ("k0", None, False, True), ("k7", "v2-7", True, False), ("none", None, False, False)
    }
    assert len(table.asked(requests)) < table.buckets
