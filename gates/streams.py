"""Streams over the given files, run until nothing new is left."""

from pyspark.sql import functions as F

from gates.registry import query
from tablewright.operators.chain import FilterStep, TextStep
from tablewright.quality.contracts import checks_from_lists
from tablewright.quality.schema import Field, TableSchema
from tablewright.session import fresh_path
from tablewright.sources.snapshots import Snapshots
from tablewright.streaming import apply_steps, enrich_stream, incremental_harvest, write_checked
from tablewright.streaming.deliveries import harvest_into, merged_profile, once_per_key, run_profiled
from tablewright.streaming.jobs import read_files, run_available


def _stream(t, table):
    schema = getattr(t, table).schema
    return read_files(t.spark, t.folder, schema, pathGlobFilter=f"{table}.parquet")


def _collect(t, stream, label):
    path, state = fresh_path(t.spark, label), fresh_path(t.spark, f"{label}-state")
    writer = stream.writeStream.format("parquet").option("path", path)
    run_available(writer.option("checkpointLocation", state))
    return t.spark.read.schema(stream.schema).parquet(path)


@query(
    "SELECT event_id, upper(event_type) AS event_type, value FROM events WHERE value >= 10"
)
def t1_stateless_steps(t):
    stream = _stream(t, "events").select("event_id", "event_type", "value")
    steps = [TextStep("event_type", "upper"), FilterStep("value", 10, ">=")]
    return _collect(t, apply_steps(stream, steps), "steps")


@query(
    """
    SELECT l_orderkey, l_partkey, l_quantity, p_name, p_brand
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
    """
)
def t2_stream_enrichment(t):
    stream = _stream(t, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    parts = t.part.withColumnRenamed("p_partkey", "l_partkey")
    enriched = enrich_stream(stream, parts, "l_partkey", ["p_name", "p_brand"])
    return _collect(t, enriched, "enriched")


@query("SELECT * FROM labels")
def t3_incremental_harvest(t):
    source, target = fresh_path(t.spark, "incoming"), fresh_path(t.spark, "harvested")
    state = fresh_path(t.spark, "harvest-state")
    schema = t.labels.schema
    for part in ("toxic = 0", "toxic = 1"):
        t.labels.filter(part).write.mode("append").option("header", True).csv(source)
        incremental_harvest(t.spark, source, schema, target, state, header=True)
    return t.spark.read.schema(schema).parquet(target)


_DELIVERIES = """
    SELECT o_orderkey, o_custkey, o_totalprice - 1 AS o_totalprice, 2 AS sent FROM orders WHERE o_orderkey % 3 <> 0
    UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, 3 AS sent FROM orders WHERE o_orderkey % 2 = 0
    UNION ALL SELECT o_orderkey, -1 AS o_custkey, 0.0 AS o_totalprice, 1 AS sent FROM orders WHERE o_orderkey % 5 = 0"""


def _snapshots(t, schema, newest):
    return Snapshots(t.spark, fresh_path(t.spark, "snapshots"), schema, ["o_orderkey"], newest, buckets=8)


@query(
    f"""
    SELECT o_orderkey, o_custkey, o_totalprice, CAST(sent AS INTEGER) AS sent FROM ({_DELIVERIES})
    QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY sent DESC) = 1
    """
)
def t3_merge_harvest(t):
    """Three deliveries of orders, the last of them late, each file twice; the newest row of each key stays."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    sent = [
        orders.filter(key % 3 != 0).withColumn("o_totalprice", price - 1).withColumn("sent", F.lit(2)),
        orders.filter(key % 2 == 0).withColumn("sent", F.lit(3)),
        orders.filter(key % 5 == 0).withColumns({"o_custkey": F.lit(-1).cast("long"), "o_totalprice": F.lit(0.0), "sent": F.lit(1)}),
    ]
    table = _snapshots(t, sent[0].schema, ["sent"])
    source, state = fresh_path(t.spark, "deliveries"), fresh_path(t.spark, "deliveries-state")
    for delivery in [*sent, sent[0]]:
        delivery.write.mode("append").parquet(source)
        harvest_into(read_files(t.spark, source, table.schema), table, state)
    return table.read()


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 2 = 0")
def t3_replace_harvest(t):
    """What arrives last takes the place of all rows before it."""
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    table = _snapshots(t, orders.schema, ())
    for part in (orders, orders.filter("o_orderkey % 2 = 0")):
        table.run(part, "replace")
    return table.read()


@query("SELECT event_id, user_id, event_type, value FROM events")
def t3_replayed_input(t):
    """All events delivered twice, the second time in another order, handled once each."""
    source, state = fresh_path(t.spark, "replayed"), fresh_path(t.spark, "replayed-state")
    for order in ("event_id", "value"):
        t.events.repartitionByRange(3, order).write.mode("append").parquet(source)
    stream = read_files(t.spark, source, t.events.schema, files_per_batch=2)
    once = once_per_key(stream, ["event_id"], "ts", "400 days").select("event_id", "user_id", "event_type", "value")
    target = fresh_path(t.spark, "once")
    run_available(once.writeStream.format("parquet").option("path", target).option("checkpointLocation", state))
    return t.spark.read.schema(once.schema).parquet(target)


@query(
    """
    SELECT c.column_name, CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE c.missing) AS BIGINT) AS nulls,
           count(*) FILTER (WHERE c.missing) / CAST(count(*) AS DOUBLE) AS null_rate
    FROM events, LATERAL (VALUES ('event_type', nullif(event_type, 'error') IS NULL), ('value', nullif(floor(value), 3) IS NULL)) AS c(column_name, missing)
    GROUP BY c.column_name
    """
)
def t4_stream_profile(t):
    """Nulls of two columns, counted by the stream itself while its batches are written."""
    source, target = fresh_path(t.spark, "profiled"), fresh_path(t.spark, "profiled-out")
    state = fresh_path(t.spark, "profiled-state")
    t.events.repartition(4).write.parquet(source)
    event_type, value = F.nullif("event_type", F.lit("error")), F.when(F.floor("value") != 3, F.col("value"))
    stream = read_files(t.spark, source, t.events.schema, files_per_batch=1).select("event_id", event_type.alias("event_type"), value.alias("value"))

    def start(observed):
        return run_available(observed.writeStream.format("parquet").option("path", target).option("checkpointLocation", state))

    return merged_profile(run_profiled(stream, "events", ["event_type", "value"], start))


@query(
    """
    SELECT event_id, event_type, value, 'valid' AS outcome FROM events
    WHERE event_type != 'error' AND value > 5
    UNION ALL SELECT event_id, event_type, value, 'quarantined' FROM events
    WHERE NOT (event_type != 'error' AND value > 5)
    """
)
def t4_checked_batches(t):
    target, quarantine = fresh_path(t.spark, "valid"), fresh_path(t.spark, "quarantine")
    rules = TableSchema(
        "events",
        {
            "event_id": Field("bigint"),
            "event_type": Field("string", isin=("click", "view", "purchase", "signup")),
            "value": Field("double", gt=5),
        },
        strict="filter",
    )
    contract = checks_from_lists("events", required=["event_id"], positive=["value"])
    state = fresh_path(t.spark, "checked-state")
    write_checked(_stream(t, "events"), rules, target, quarantine, state, contract)
    columns = ["event_id", "event_type", "value"]
    good = t.spark.read.parquet(target).select(*columns, F.lit("valid").alias("outcome"))
    bad = t.spark.read.parquet(quarantine).select(*columns, F.lit("quarantined").alias("outcome"))
    return good.unionByName(bad)
