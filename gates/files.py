"""Sources and sinks: a given table is written, read back and compared."""

from pyspark.sql import functions as F

from gates.registry import query
from tablewright import sources as R
from tablewright.operators.sql import sql_to_parquet
from tablewright.session import fresh_path
from tablewright.sources.readers import read_partitioned


_DOCUMENTS_WITH_LABELS = "SELECT * FROM documents LEFT JOIN labels USING (doc_id)"


def _documents_with_labels(t):
    """Text with line breaks and quotes, and numbers that are null."""
    return t.documents.join(t.labels, "doc_id", "left")


@query(_DOCUMENTS_WITH_LABELS)
def s1_csv_harvest(t):
    csv, raw = fresh_path(t.spark, "csv"), fresh_path(t.spark, "raw")
    rows = _documents_with_labels(t)
    R.write_csv(rows, csv)
    R.harvest_csv(t.spark, csv, rows.schema, raw, "documents_raw", multiline=True)
    return R.read_raw_table(t.spark, raw, "documents_raw")


@query("SELECT * REPLACE (CAST(c_custkey AS INTEGER) AS c_custkey, CAST(c_nationkey AS INTEGER) AS c_nationkey) FROM customer")
def s1_csv_harvest_with_inferred_types(t):
    csv, raw = fresh_path(t.spark, "csv"), fresh_path(t.spark, "raw")
    R.write_csv(t.customer, csv)
    R.harvest_csv(t.spark, csv, None, raw, "customer_raw")
    return R.read_raw_table(t.spark, raw, "customer_raw")


@query("SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 40")
def s3_raw_parquet_scan(t):
    table = R.read_parquet_table(
        t.spark, t.folder, "lineitem.parquet", ["l_orderkey", "l_quantity"], "gate"
    )
    return table.filter("l_quantity > 40").select("l_orderkey", "l_quantity")


@query("SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def s4_multi_table_read(t):
    raw = fresh_path(t.spark, "raw")
    R.write_parquet(t.nation, f"{raw}/raw/nation")
    R.write_parquet(t.region, f"{raw}/raw/region")
    tables = R.read_raw_tables(t.spark, raw, ("nation", ["n_name"]), ("region", None))
    joined = tables["nation"].join(tables["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select("n_name", "r_name")


@query("SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY s_nationkey")
def s5_view_registration(t):
    raw = fresh_path(t.spark, "raw")
    R.write_parquet(t.supplier, f"{raw}/raw/supplier_raw")
    R.register_views(t.spark, raw, {"gate_supplier": "supplier_raw"})
    return t.spark.sql("SELECT s_nationkey, count(*) AS n FROM gate_supplier GROUP BY s_nationkey")


@query("SELECT * FROM supplier")
def s6_catalog_table(t):
    path = fresh_path(t.spark, "supplier")
    R.write_parquet(t.supplier, path)
    name = f"gate_{path[-32:]}"
    t.spark.catalog.createTable(name, path=path, source="parquet")
    return R.read_table(t.spark, name, "default", ["s_suppkey", "s_name"], "gate")


@query(
    """
    SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS title, p_type AS kind,
           CAST(p_size AS VARCHAR) AS size, p_brand AS brand, CAST(NULL AS VARCHAR) AS absent,
           '[{"lang":"en","value":"' || p_name || '"},{"lang":"up","value":"' || upper(p_name) || '"}]'
             AS names
    FROM part
    """
)
def s7_xml_source(t):
    def name(lang, text):
        return F.struct(F.lit(lang).alias("_lang"), text.alias("_VALUE"))

    records = t.part.select(
        F.col("p_partkey").alias("_id"),
        F.col("p_name").alias("title"),
        F.struct(F.col("p_type").alias("_kind"), F.col("p_size").alias("size")).alias("body"),
        F.struct(
            F.array(name("en", F.col("p_name")), name("up", F.upper("p_name"))).alias("name")
        ).alias("names"),
        F.col("p_brand").alias("brand"),
    )
    path = fresh_path(t.spark, "xml")
    R.write_xml(records, path, "part", "parts")
    return R.read_xml(
        t.spark,
        path,
        "part",
        {
            "id": "./@id",
            "title": "./title/text()",
            "kind": "./body/@kind",
            "size": "./body/size/text()",
            "brand": "./brand",
            "absent": "./nothing/text()",
        },
        {"names": ("./names/name", ["@lang", "value"])},
    )


@query(
    """
    SELECT CAST(p_partkey AS VARCHAR) AS id,
           '[{"kind":"' || p_type || '","size":"' || CAST(p_size AS VARCHAR) || '"'
             || CASE WHEN p_size % 2 = 0 THEN ',"brand":"' || p_brand || '"' ELSE '' END
             || ',"value":"' || p_name || '"}]' AS bodies
    FROM part
    """
)
def s7_xml_nested_in_full(t):
    body = F.struct(
        F.col("p_type").alias("_kind"),
        F.array(F.lit(-1), F.col("p_size")).alias("size"),  # the last of repeated children counts
        F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).alias("brand"),
        F.col("p_name").alias("_VALUE"),
    )
    path = fresh_path(t.spark, "xml")
    records = t.part.select(F.struct(F.col("p_partkey").alias("_id"), body.alias("body")).alias("item"))
    R.write_xml(records, path, "part", "parts")
    bodies = R.read_xml(t.spark, path, "part/item", {"id": "./@id"}, {"bodies": ("./body", None)})
    parts = F.from_json("bodies", "array<map<string,string>>")[0]
    keys = [F.when(F.map_contains_key(parts, k), F.concat(F.lit(f'"{k}":"'), parts[k], F.lit('"')))
            for k in ("kind", "size", "brand", "value")]
    return bodies.select("id", F.concat(F.lit("[{"), F.concat_ws(",", *keys), F.lit("}]")).alias("bodies"))


@query(
    """
    SELECT p_partkey AS id, '[{"kind":"' || p_type || '","size":"' || p_size || '"'
      || CASE WHEN p_size % 2 = 0 THEN ',"brand":"' || p_brand || '"' ELSE '' END || '}]' AS bodies FROM part
    """
)
def s8_xml_column_in_full(t):
    """All attributes and children of a nested element in a text column, without naming them."""
    body = F.struct(
        F.col("p_type").alias("_kind"), F.col("p_size").alias("size"), F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).alias("brand")
    )
    cells = t.part.select(F.col("p_partkey").alias("id"), F.to_xml(F.struct(body.alias("body")), {"rowTag": "item"}).alias("xml"))
    parsed = R.parse_xml_column(cells, "xml", {}, {"bodies": ("./body", None)})
    parts = F.from_json("bodies", "array<map<string,string>>")[0]
    keys = [F.when(F.map_contains_key(parts, k), F.concat(F.lit(f'"{k}":"'), parts[k], F.lit('"'))) for k in ("kind", "size", "brand")]
    return parsed.select("id", F.concat(F.lit("[{"), F.concat_ws(",", *keys), F.lit("}]")).alias("bodies"))


@query(
    """
    SELECT doc_id, lang, CAST(n_chars AS VARCHAR) AS size, source, text FROM documents
    """
)
def s8_xml_column(t):
    clean = F.regexp_replace("text", r"[^\x{9}\x{A}\x{20}-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]", "")
    record = F.struct(
        F.col("lang").alias("_lang"),
        F.struct(F.col("source").alias("_source"), F.col("n_chars").alias("size")).alias("about"),
        clean.alias("text"),
    )
    xml = t.documents.select("doc_id", F.to_xml(record).alias("xml"))
    parsed = R.parse_xml_column(
        xml,
        "xml",
        {
            "lang": "./@lang",
            "size": "./about/size/text()",
            "source": "./about/@source",
            "text": "./text/text()",
        },
    )
    return parsed.drop("xml")


@query("SELECT * FROM orders")
def s9_parquet_sink(t):
    path = fresh_path(t.spark, "orders")
    R.write_parquet(t.orders, path)
    return t.spark.read.parquet(path)


@query("SELECT doc_id, text, lang, quality FROM documents LEFT JOIN labels USING (doc_id)")
def s10_json_sink(t):
    joined = t.documents.select("doc_id", "text", "lang").join(
        t.labels.select("doc_id", "quality"), "doc_id", "left"
    )
    path = fresh_path(t.spark, "json")
    R.write_json(joined, path)
    return t.spark.read.schema(joined.schema).json(path)


@query(_DOCUMENTS_WITH_LABELS)
def s11_json_array_source(t):
    path = fresh_path(t.spark, "json-array")
    rows = _documents_with_labels(t)
    R.write_json_array(rows, path)
    return R.read_json_array_parts(t.spark, path, rows.schema)


@query("SELECT event_id, user_id, value, event_type FROM events WHERE event_type = 'click'")
def s12_partitioned_parquet(t):
    path = fresh_path(t.spark, "events")
    events = t.events.select("event_id", "user_id", "value", "event_type")
    R.write_parquet(events, path, partition_by=["event_type"])
    return read_partitioned(t.spark, path, event_type="click")


@query(_DOCUMENTS_WITH_LABELS)
def s13_csv_sink(t):
    rows = _documents_with_labels(t)
    path = fresh_path(t.spark, "csv")
    R.write_csv(rows, path)
    return R.read_csv(t.spark, path, rows.schema, multiline=True)


@query("SELECT l_returnflag, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_returnflag")
def p10_sql_to_parquet(t):
    path = fresh_path(t.spark, "quantities")
    sql_to_parquet(
        t.spark,
        "SELECT l_returnflag, sum(l_quantity) AS quantity FROM gate_lineitem GROUP BY l_returnflag",
        path,
        upstream={"gate_lineitem": f"{t.folder}/lineitem.parquet"},
    )
    return t.spark.read.parquet(path)


@query(
    """
    SELECT o_orderkey, o_totalprice AS total, (SELECT count(*) FROM orders) AS filtered_from
    FROM orders WHERE o_totalprice >= 250000
    """
)
def p11_parquet_to_json(t):
    path = fresh_path(t.spark, "published")
    result = R.publish(
        t.spark,
        f"{t.folder}/orders.parquet",
        path,
        where="o_totalprice >= 250000",
        select=["o_orderkey", "o_totalprice AS total"],
    )
    read = t.spark.read.schema("o_orderkey long, total double").json(path)
    return read.withColumn("filtered_from", F.lit(result.metrics["filtered_from"]).cast("long"))
