"""Sources and sinks."""

import json
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from tablewright import sources as R
from tablewright.errors import MissingColumn, MissingTable
from tablewright.sources.readers import read_partitioned, relational_options


def _lines(path):
    return [x for f in sorted(Path(path).glob("part-*")) for x in f.read_text().splitlines()]


def test_csv_harvest_replaces_the_raw_table(spark, folder, rows):
    csv = Path(folder("in"))
    csv.mkdir()
    (csv / "a.csv").write_text("id,day,price\n1,2020-01-01,5\n2,,\n")
    schema = "id long, day string, price double"
    for _ in range(2):
        R.harvest_csv(spark, str(csv), schema, folder("raw"), "sales_raw")
    df = R.read_raw_table(spark, folder("raw"), "sales_raw", required=["id"])
    assert rows(df) == [(1, "2020-01-01", 5.0), (2, None, None)]
    (csv / "b.csv").write_text("id,day,price\nx,2020-01-01,5\n")
    with pytest.raises(Py4JJavaError, match="MALFORMED_RECORD"):
        R.harvest_csv(spark, str(csv), schema, folder("raw2"), "t")


def test_raw_reads_name_what_there_is(spark, frame, folder):
    frame("a int, b int", (1, 2)).write.parquet(folder("h/raw/one"))
    Path(folder("h/raw/empty")).mkdir()
    with pytest.raises(MissingTable) as error:
        R.read_raw_table(spark, folder("h"), "two", caller="me")
    assert "one" in str(error.value) and "[me]" in str(error.value)
    with pytest.raises(MissingColumn) as error:
        R.read_raw_table(spark, folder("h"), "one", required=["a", "z"])
    assert error.value.missing == ["z"] and "b" in str(error.value)
    with pytest.raises(FileNotFoundError):
        R.read_raw_table(spark, folder("h"), "empty")
    with pytest.raises(FileNotFoundError):
        R.read_raw_table(spark, folder("nowhere"), "one")
    assert set(R.read_raw_tables(spark, folder("h"), ("one", ["a"]))) == {"one"}


def test_views_with_short_names(spark, frame, folder, rows):
    frame("v int", (1,)).write.parquet(folder("h/raw/sales_raw"))
    frame("v int", (2,)).write.parquet(folder("h/raw/extra"))
    R.register_views(spark, folder("h"), ["sales", "extra"])
    assert rows(spark.sql("SELECT v FROM sales UNION ALL SELECT v FROM extra")) == [(1,), (2,)]


def test_catalog_tables(spark, frame, folder, rows):
    frame("v int", (1,)).write.parquet(folder("t"))
    spark.catalog.createTable("kept_numbers", path=folder("t"), source="parquet")
    assert rows(R.read_table(spark, "kept_numbers", required=["v"])) == [(1,)]
    with pytest.raises(MissingTable) as error:
        R.read_table(spark, "lost_numbers")
    assert "kept_numbers" in str(error.value)
    with pytest.raises(MissingTable):
        R.read_table(spark, "x", schema="no_such_schema")
    with pytest.raises(MissingColumn):
        R.read_table(spark, "kept_numbers", required=["w"])


def test_relational_options_slice_the_table():
    options = relational_options("jdbc:x", "t", key="id", bounds=(1, 100), partitions=4)
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "4"
    assert "partitionColumn" not in relational_options("jdbc:x", "t")
    with pytest.raises(ValueError):
        relational_options("jdbc:x", "t", key="id")


def test_parquet_counts_during_the_write(spark, frame, folder, rows):
    df = frame("k string, v int", ("a", 1), ("b", 2), ("a", 3))
    result = R.write_parquet(df, folder(), partition_by=["k"], metrics={"total": F.sum("v")})
    assert result.rows == 3 and result.metrics["total"] == 6
    assert list(Path(folder()).glob("k=a/*.zstd.parquet"))
    pruned = read_partitioned(spark, folder(), k="a")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(k" in plan
    assert rows(pruned.select("v")) == [(1,), (3,)]


def test_json_lines_keep_nulls_and_drop_nan(frame, folder):
    df = frame(
        "a double, b string, c array<double>, d struct<x:double,y:int>",
        (float("nan"), None, [1.0, float("inf")], (float("-inf"), 1)),
        (1.5, "x", None, None),
    )
    result = R.write_json(df, folder(), metrics={"top": F.max("a")})
    found = sorted((json.loads(x) for x in _lines(folder())), key=lambda r: r["b"] or "")
    assert found == [
        {"a": None, "b": None, "c": [1.0, None], "d": {"x": None, "y": 1}},
        {"a": 1.5, "b": "x", "c": None, "d": None},
    ]
    assert result.rows == 2 and result.metrics["top"] == 1.5


@pytest.mark.parametrize("count", [0, 1, 20, 100_100])
def test_json_array_in_parts(spark, folder, rows, count):
    df = spark.range(count).selectExpr("cast(id as int) i", "if(id % 2 = 1, null, cast(id as string)) s")
    assert R.write_json_array(df.orderBy(F.desc("i")), folder()).rows == count
    document = "\n".join(_lines(folder()))
    assert [r["i"] for r in json.loads(document)] == list(range(count - 1, -1, -1))
    assert len(list(Path(folder()).glob("part-*"))) >= min(2, count // 1000)
    assert rows(R.read_json_array_parts(spark, folder(), df.schema)) == rows(df)


def test_json_array_in_one_file(spark, folder, rows):
    Path(folder()).write_text('[{"i": 1},\n{"i": 2}]')
    assert rows(R.read_json_array(spark, folder(), "i int")) == [(1,), (2,)]


def test_partitioned_files_are_few(spark, folder):
    df = spark.range(4000).repartition(40).selectExpr("id", "id % 20 as k")
    R.write_parquet(df, folder(), partition_by=["k"])
    assert len(list(Path(folder()).rglob("part-*"))) < 100
    assert spark.read.parquet(folder()).count() == 4000


def test_numbers_inside_maps_are_cleaned(spark, folder):
    df = spark.sql("select map('a', double('nan'), 'b', 1.5D, 'c', null) m, map('k', 1) n")
    (row,) = R.clean_numbers(df).collect()
    assert row.m == {"a": None, "b": 1.5, "c": None} and row.n == {"k": 1}


def test_publish_reads_a_plan_once(spark, folder):
    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    df = spark.range(50).mapInPandas(count, "id long")
    result = R.publish(spark, df, folder(), "id >= 10")
    assert result.metrics == {"record_count": 40, "filtered_from": 50} and seen.value == 50


def test_csv_types_are_inferred_if_asked_for(spark, folder, rows):
    Path(folder("in")).mkdir()
    Path(folder("in"), "a.csv").write_text('id,price,day,name\n1,2.5,2020-01-01,"x\ny"\n2,,,z\n')
    df = R.read_csv(spark, folder("in"), multiline=True)
    assert [t for _, t in df.dtypes] == ["int", "double", "date", "string"] and df.count() == 2
    assert rows(df.select("name")) == [("x\ny",), ("z",)]


def test_publish_counts_before_and_after(spark, frame, folder, rows):
    frame("id int, diff int", (1, 5), (2, 50)).write.parquet(folder("in"))
    result = R.publish(spark, folder("in"), folder(), "diff >= 10", ["id", "diff AS difference"])
    assert result.metrics == {"record_count": 1, "filtered_from": 2}
    assert [json.loads(x) for x in _lines(folder())] == [{"id": 2, "difference": 50}]


def test_csv_sink(spark, frame, folder, rows):
    df = frame("id int, s string", (1, 'a,"b"'), (2, "line\nbreak"), (None, " back\\slash "), (4, None))
    assert R.write_csv(df, folder()).rows == 4
    assert rows(R.read_csv(spark, folder(), df.schema, multiline=True)) == rows(df)


CATALOG = """<?xml version="1.0" encoding="UTF-8"?>
<c:CATALOG xmlns:c="http://example.org/c">
  <PLANT id="P1"><COMMON>Bloodroot</COMMON><PRICE unit="usd">$2.44</PRICE>
    <IMAGES><IMAGE type="thumb">a.jpg</IMAGE><IMAGE>b.jpg</IMAGE></IMAGES>
    <COMPANIONS><PLANT><COMMON>Trillium</COMMON></PLANT><PLANT>Hepatica</PLANT></COMPANIONS>
    <tag>x</tag><tag>y</tag></PLANT>
  <PLANT id="P2"><COMMON>Columbine &amp; Co</COMMON><tag>only</tag></PLANT>
</c:CATALOG>
"""
FIELDS = {
    "id": "./@id",
    "common": "./COMMON/text()",
    "price": "./PRICE/text()",
    "unit": "./PRICE/@unit",
    "first_image": "./IMAGES/IMAGE/text()",
    "tags": "./tag",
    "absent": "./nothing",
}
NESTED = {
    "images": ("./IMAGES/IMAGE", ["@type", "value"]),
    "companions": ("./COMPANIONS/PLANT", ["COMMON", "value"]),
}
EXPECTED = [
    (
        "P1", "Bloodroot", "$2.44", "usd", "a.jpg", '["x","y"]', None,
        '[{"type":"thumb","value":"a.jpg"},{"value":"b.jpg"}]',
        '[{"COMMON":"Trillium"},{"value":"Hepatica"}]',
    ),
    ("P2", "Columbine & Co", None, None, None, "only", None, None, None),
]


def test_xml_files(spark, folder, rows):
    Path(folder("catalog.xml")).write_text(CATALOG)
    df = R.read_xml(spark, folder("catalog.xml"), "PLANT", FIELDS, NESTED)
    assert rows(df) == EXPECTED


def test_xml_files_stay_small(spark, folder):
    """However few tasks write, no file has more than so many records; all are read again, by several tasks."""
    df = spark.range(1000).coalesce(1).selectExpr("id AS _id", "concat('n', id) AS name", "if(id % 7 = 0, null, id) AS size")
    assert R.write_xml(df, folder(), "part", "parts", records=100).rows == 1000
    files = [p.read_text().count("<part ") for p in Path(folder()).glob("part-*")]
    assert len(files) >= 10 and max(files) <= 100
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        found = R.read_xml(spark, folder(), "part", {"id": "./@id", "name": "./name/text()", "size": "./size/text()"})
        assert found.rdd.getNumPartitions() > 1
        want = {(str(i), f"n{i}", str(i) if i % 7 else None) for i in range(1000)}
        assert {tuple(r) for r in found.collect()} == want and found.count() == 1000
        assert R.write_xml(df.limit(0), folder("none"), "part", "parts").rows == 0
        assert R.read_xml(spark, folder("none"), "part", {"id": "./@id"}).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_registered_xml_queries_write_small_files(spark, tmp_path, monkeypatch):
    """The queries that write XML leave no file that grows with a task's rows."""
    from gates import QUERIES
    from tablewright.sources import sinks

    spark.read.parquet("/root/testdata/sf0.001/part.parquet").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(sinks.write_xml, "__defaults__", ("overwrite", 20))
    for name in ("s7_xml_source", "s7_xml_nested_in_full"):
        found = QUERIES[name](spark, str(tmp_path))
        assert found.count() == spark.read.parquet(f"{tmp_path}/part.parquet").count() and len(found.inputFiles()) >= 10


def test_xml_column(frame, rows):
    records = CATALOG.split("<PLANT id=")[1:]
    cells = [("<PLANT id=" + r.split("</c:CATALOG>")[0],) for r in records]
    df = R.parse_xml_column(frame("xml string", *cells), "xml", FIELDS, NESTED)
    assert rows(df.drop("xml")) == EXPECTED


ITEMS = """<?xml version="1.0"?>
<all><list><rec><i t="a" u="b"><n>1</n><n>2</n><z>q</z><e/> txt </i><i v="c"/></rec></list>
<list><rec><i><n>3</n></i></rec></list><other><rec><i t="x"/></rec></other></all>
"""


def test_nested_elements_in_full(spark, folder):
    Path(folder()).write_text(ITEMS)
    found = [json.loads(r.i) for r in R.read_xml(spark, folder(), "rec", {}, {"i": ("./i", None)}).collect()]
    assert found == [
        [{"t": "a", "u": "b", "n": "2", "z": "q", "e": None, "value": "txt"}, {"v": "c"}],
        [{"n": "3"}],
        [{"t": "x"}],
    ]
    at_path = R.read_xml(spark, folder(), "list/rec", {}, {"i": ("./i", ["n"])}).collect()
    assert [json.loads(r.i) for r in at_path] == [[{"n": "2"}, {}], [{"n": "3"}]]


def test_nested_elements_of_a_column_in_full(spark, frame, rows):
    cells = [(i, f"<rec>{c}</rec>") for i, c in enumerate(ITEMS.split("<rec>")[1:])]
    cells = [(i, c.split("</rec>")[0] + "</rec>") for i, c in cells]
    df = frame("id int, x string", *cells, (3, None), (4, "<rec/>"))
    found = R.parse_xml_column(df, "x", {"first": "./i/n/text()"}, {"i": ("./i", None), "n": ("./i", ["n"])})
    assert [(r.id, r.first, r.i and json.loads(r.i), r.n and json.loads(r.n)) for r in found.orderBy("id").collect()] == [
        (0, "1", [{"t": "a", "u": "b", "n": "2", "z": "q", "e": None, "value": "txt"}, {"v": "c"}], [{"n": "2"}, {}]),
        (1, "3", [{"n": "3"}], [{"n": "3"}]),
        (2, None, [{"t": "x"}], [{}]),
        (3, None, None, None),
        (4, None, None, None),
    ]
    stream = spark.readStream.format("rate").load().selectExpr("cast(value as string) as x")
    with pytest.raises(ValueError, match="stream"):
        R.parse_xml_column(stream, "x", {}, {"i": ("./i", None)})


def test_staged_tables_can_be_dropped(spark, tmp_path, monkeypatch):
    from tablewright import session

    monkeypatch.setattr(session, "checkpoint_dir", lambda _: str(tmp_path))
    assert session.stage(spark.range(5).toDF("i")).count() == 5 and list(tmp_path.iterdir())
    session.drop_stages(spark)
    assert not list(tmp_path.iterdir())


def test_a_local_session_without_a_shared_folder_gets_one(spark, monkeypatch):
    from tablewright import session

    monkeypatch.setattr(type(spark.conf), "get", lambda *_: None)
    first = session.checkpoint_dir(spark)
    assert Path(first).is_dir() and session.checkpoint_dir(spark) == first
