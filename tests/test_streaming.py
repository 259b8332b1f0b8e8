"""Streams give what the same operators give on a stored table."""

import random
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright import sources as S
from tablewright import streaming as X
from tablewright.functions import strip, title_case
from tablewright.operators import columns as C
from tablewright.operators.chain import FilterStep, TextStep
from tablewright.operators.diff import diff_tables
from tablewright.operators.sql import sql_transform
from tablewright.quality.contracts import checks_from_lists
from tablewright.quality.schema import Field, TableSchema
from tablewright.streaming.jobs import as_event_time, read_files, run_available

SCHEMA = "id int, name string, price double"


@pytest.fixture
def incoming(frame, folder):
    def add(*rows):
        frame(SCHEMA, *rows).coalesce(1).write.mode("append").parquet(folder("incoming"))

    add((1, " ann ", 5.0), (2, "BOB", None))
    add((3, "cid", 50.0))
    return add


def _run(spark, stream, folder, name):
    writer = stream.writeStream.format("parquet").option("path", folder(name))
    run_available(writer.option("checkpointLocation", folder(name + "-state")))
    return spark.read.schema(stream.schema).parquet(folder(name))


def test_row_by_row_steps(spark, incoming, folder):
    steps = [
        TextStep("name", "strip"),
        FilterStep("price", 1),
        lambda df: df.withColumn("title", title_case(strip("name"))),
        lambda df: C.rename(df, {"price": "cost"}),
        lambda df: sql_transform(df, "SELECT *, cost * 2 AS doubled FROM _input"),
    ]
    stream = X.apply_steps(read_files(spark, folder("incoming"), SCHEMA, files_per_batch=1), steps)
    assert stream.isStreaming
    stored = X.apply_steps(spark.read.parquet(folder("incoming")), steps)
    assert diff_tables(stored, _run(spark, stream, folder, "out")).matches()
    with pytest.raises(ValueError):
        C.drop_null_columns(stream)


def test_enrichment_by_a_stored_table(spark, incoming, frame, folder):
    static = frame("id int, country string, other int", (1, "FR", 0), (3, "DE", 0))
    stream = X.enrich_stream(
        read_files(spark, folder("incoming"), SCHEMA), static, "id", ["country"]
    )
    stored = spark.read.parquet(folder("incoming")).join(static.drop("other"), "id", "left")
    assert diff_tables(stored, _run(spark, stream, folder, "out")).matches()


def test_incremental_harvest_takes_each_file_once(spark, folder, rows):
    csv = Path(folder("csv"))
    csv.mkdir()

    def harvest():
        X.incremental_harvest(
            spark, str(csv), "id int, v string", folder("raw"), folder("state"), header=True,
            transform=lambda df: df.withColumn("v", F.upper("v")),
        )
        return rows(spark.read.parquet(folder("raw")))

    (csv / "a.csv").write_text("id,v\n1,x\n")
    assert harvest() == [(1, "X")]
    (csv / "b.csv").write_text("id,v\n2,y\n3,z\n")
    assert harvest() == [(1, "X"), (2, "Y"), (3, "Z")]
    assert harvest() == [(1, "X"), (2, "Y"), (3, "Z")]


RULES = TableSchema("t", {"id": Field("int"), "price": Field("double", gt=10)})


def test_bad_rows_go_to_quarantine(spark, incoming, folder, rows):
    def write():
        stream = read_files(spark, folder("incoming"), SCHEMA, files_per_batch=1)
        X.write_checked(stream, RULES, folder("good"), folder("bad"), folder("state"))

    write()
    write()
    assert [r[0] for r in rows(spark.read.parquet(folder("good")))] == [3]
    bad = spark.read.parquet(folder("bad"))
    assert sorted((r.id, [e.check for e in r._errors]) for r in bad.collect()) == [
        (1, ["greater_than(10)"]), (2, ["not_nullable"])
    ]
    incoming((4, "new", 99.0))
    write()
    assert [r[0] for r in rows(spark.read.parquet(folder("good")))] == [3, 4]


def test_failed_contract_stops_the_query(spark, incoming, folder):
    stream = read_files(spark, folder("incoming"), SCHEMA)
    contract = checks_from_lists("t", min_rows=5)
    with pytest.raises(StreamingQueryException, match="row_count"):
        X.write_checked(stream, RULES, folder("good"), folder("bad"), folder("state"), contract)
    assert not Path(folder("good")).exists()


def test_event_time(frame):
    df = frame("ts timestamp_ntz").transform(lambda d: as_event_time(d, "ts"))
    assert df.schema["ts"].dataType.simpleString() == "timestamp"


# input that arrives again, late or corrected


def _table(spark, folder, newest=("sent",), buckets=4, schema="k int, v string, sent int", name="table"):
    return S.Snapshots(spark, folder(name), T.StructType.fromDDL(schema), ["k"], list(newest), buckets)


OLD = [(1, "a", 1), (2, "b", 1), (None, "n", 1), (3, "c", 5)]
NEW = [(2, "B", 2), (3, "late", 4), (4, "d", 1), (4, "D", 3), (None, None, 0), (None, "N", None)]
MERGED = {(1, "a", 1), (2, "B", 2), (3, "c", 5), (4, "D", 3), (None, "n", 1)}


def test_dispositions(spark, frame, folder, rows):
    schema = "k int, v string, sent int"
    old, new = frame(schema, *OLD), frame(schema, *NEW)
    table = _table(spark, folder)
    assert table.read().count() == 0 and table.run(old, "append") == 1
    assert table.run(new, "append") == 2 and rows(table.read()) == sorted(OLD + NEW, key=repr)
    assert table.run(old, "replace") == 3 and rows(table.read()) == sorted(OLD, key=repr)
    assert table.run(new, "merge") == 4 and set(rows(table.read())) == MERGED
    # every earlier version is still there
    assert rows(table.read(2)) == sorted(OLD + NEW, key=repr) and table.read(1).count() == 4
    assert table.run(old.limit(0), "merge") == 5 and set(rows(table.read())) == MERGED
    assert table.run(old.limit(0), "replace") == 6 and table.read().count() == 0
    with pytest.raises(ValueError, match="disposition"):
        table.run(old, "upsert")


@pytest.mark.parametrize("buckets", [1, 3, 50])
def test_order_of_arrival_decides_nothing(spark, frame, folder, rows, buckets):
    """Any order of deliveries, repeated or not, gives the rows of one batch run."""
    dice = random.Random(buckets)
    schema = "k int, v string, sent int"
    parts = [[(dice.choice([None, 1, 2, 3, 4]), dice.choice("ab"), dice.randint(0, 2)) for _ in range(6)] for _ in range(4)]
    whole = _table(spark, folder, buckets=buckets, name="whole")
    whole.run(frame(schema, *[r for p in parts for r in p]))
    for trial in range(2):
        dice.shuffle(parts)
        table = _table(spark, folder, buckets=buckets, name=f"t{trial}")
        for part in [*parts, parts[0]]:
            table.run(frame(schema, *part))
        assert rows(table.read()) == rows(whole.read())


def test_a_merge_leaves_other_buckets_alone(spark, frame, folder):
    schema = "k int, v string, sent int"
    table = _table(spark, folder, buckets=16)
    table.run(frame(schema, *[(i, "x", 0) for i in range(200)]))
    before = {r.bucket: r.folder for r in table.versions().filter("version = 1").collect()}
    table.run(frame(schema, (7, "y", 1)))
    after = {r.bucket: r.folder for r in table.versions().filter("version = 2").collect()}
    assert before.keys() == after.keys() and sum(before[b] != after[b] for b in before) == 1


def test_a_batch_that_runs_again_changes_nothing(spark, frame, folder, rows):
    table = _table(spark, folder)
    one = frame("k int, v string, sent int", (1, "a", 1))
    assert [table.run(one, "append", batch=0), table.run(one, "append", batch=0), table.run(one, "append", batch=1)] == [1, 1, 2]
    assert rows(table.read()) == [(1, "a", 1)] * 2


def test_a_run_that_dies_leaves_the_last_version(spark, frame, folder, rows):
    table = _table(spark, folder)
    table.run(frame("k int, v string, sent int", (1, "a", 1)))
    bad = frame("k int, v string, sent int", (2, "b", 1)).withColumn("v", F.raise_error(F.lit("lost")))
    with pytest.raises(Exception, match="lost"):
        table.run(bad)
    assert rows(table.read()) == [(1, "a", 1)]
    # two runs that began with the same version: the second one to end fails
    Path(folder("table"), "versions", f"{2:012d}").mkdir()
    with pytest.raises(AnalysisException):
        table.run(frame("k int, v string, sent int", (3, "c", 1)))


def test_harvest_into_merges_files_that_arrive_again(spark, frame, folder, rows):
    table = _table(spark, folder)

    def deliver(*found):
        frame("k int, v string, sent int", *found).coalesce(1).write.mode("append").parquet(folder("in"))
        X.harvest_into(read_files(spark, folder("in"), table.schema), table, folder("state"))

    deliver(*OLD)
    deliver(*NEW)
    deliver(*OLD)
    assert set(rows(table.read())) == MERGED


def test_each_event_once_within_the_delay(spark, frame, folder, rows):
    schema = "id int, at timestamp_ntz, v int"
    day = lambda n: datetime(2024, 1, n)
    deliveries = [
        [(1, day(1), 1), (2, day(2), 2), (2, day(2), 2)],
        [(1, day(1), 1), (3, day(3), 3)],
        [(4, day(20), 4)],
        [(5, day(18), 5), (4, day(20), 4)],  # late, but within the delay
        [(6, day(2), 6)],  # later than that
    ]
    for found in deliveries:
        frame(schema, *found).coalesce(1).write.mode("append").parquet(folder("in"))
        stream = X.once_per_key(read_files(spark, folder("in"), schema), ["id"], "at", "5 days").select("id", "v")
        out = _run(spark, stream, folder, "out")
    assert rows(out) == [(i, i) for i in range(1, 6)]


def test_profiles_of_batches(spark, incoming, folder, rows):
    incoming((4, None, None), (5, None, 1.0))
    stream = read_files(spark, folder("incoming"), SCHEMA, files_per_batch=1)
    found = X.run_profiled(stream, "p", ["name", "price"], lambda s: run_available(
        s.writeStream.format("parquet").option("path", folder("out")).option("checkpointLocation", folder("state"))))
    whole = rows(X.merged_profile(found).select("column_name", "rows", "nulls"))
    stored = spark.read.parquet(folder("incoming"))
    want = [(c, stored.count(), stored.filter(F.col(c).isNull()).count()) for c in ("name", "price")]
    assert whole == want and found.select("batch_id").distinct().count() == 3
    sizes = {r.rows for r in found.collect()}
    assert sizes == {1, 2} and stored.count() == spark.read.parquet(folder("out")).count()
    # nothing new: no batch, no rows
    again = X.run_profiled(stream, "p", ["name"], lambda s: run_available(
        s.writeStream.format("parquet").option("path", folder("out")).option("checkpointLocation", folder("state"))))
    assert again.count() == 0
