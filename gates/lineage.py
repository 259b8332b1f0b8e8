"""Column lineage, statistics and examples."""

from pyspark.sql import functions as F

from gates.checks import _ERRORS, DOCUMENT_RULES, _labelled
from gates.registry import query
from gates.roles import WITH_SALES, artists, artworks, sales
from gates.values import _display_sql
from tablewright import lineage as L
from tablewright import plans
from tablewright.quality.schema import validation_report
from tablewright.session import fresh_path
from tablewright.sources import write_parquet


@query(
    f"""
    WITH {_ERRORS},
    edges AS (
      SELECT * FROM (VALUES
        ('checked', 'lang', 'documents', 'lang', 'passthrough'),
        ('checked', 'quality', 'labels', 'quality', 'passthrough'),
        ('checked', 'n_chars', 'documents', 'text', 'rename'),
        ('checked', 'toxic', 'labels', 'toxic', 'computed'),
        ('checked', 'toxic', 'documents', 'doc_id', 'computed'))
      AS e(output_table, output_column, source_table, source_column, kind))
    SELECT edges.*, "check", count(*) AS failures FROM edges JOIN errors ON "column" = output_column
    GROUP BY ALL
    """
)
def l1_column_lineage(t):
    edges = L.column_lineage(
        t.spark,
        "checked",
        passthrough={"lang": "documents", "quality": "labels"},
        rename={"n_chars": ("documents", "text")},
        computed={"toxic": [("labels", "toxic"), ("documents", "doc_id")]},
    )
    return L.trace_errors(edges, validation_report(_labelled(t), DOCUMENT_RULES))


@query(
    """
    WITH failures AS (
      SELECT 'report' AS t, 'chars' AS c, count(*) AS n FROM documents WHERE n_chars > 500
      UNION ALL SELECT 'report', 'label', count(*) FROM labels WHERE quality = 0
      UNION ALL SELECT 'lonely', 'score', count(*) FROM labels WHERE toxic = 1
    )
    SELECT source_table, source_column, 'limit' AS "check", CAST(sum(n) AS BIGINT) AS failures, count(*) AS outputs FROM (VALUES
      ('chars', 'documents', 'text'), ('label', 'labels', 'quality'), ('label', 'documents', 'text'), ('score', 'lonely', 'score')
    ) AS r(c, source_table, source_column) JOIN failures USING (c) GROUP BY ALL
    """
)
def l1_roots_of_failures(t):
    """Failures of a report, led back over two tables to the raw columns; two columns are made from each other."""
    edges = (
        L.column_lineage(t.spark, "clean", passthrough={"text": "documents"}, rename={"mark": ("labels", "quality")})
        .unionByName(L.column_lineage(t.spark, "joined", computed={"size": [("clean", "text"), ("joined", "trend")], "trend": [("joined", "size")]}))
        .unionByName(L.column_lineage(t.spark, "joined", rename={"mark": ("clean", "mark")}))
        .unionByName(L.column_lineage(t.spark, "report", computed={"chars": [("joined", "size")], "label": [("joined", "mark"), ("joined", "trend")]}))
    )
    count, limit = F.count(F.lit(1)).alias("failures"), F.lit("limit").alias("check")
    report = (
        t.documents.filter("n_chars > 500").agg(count).select(F.lit("report").alias("table"), F.lit("chars").alias("column"), limit, "failures")
        .unionByName(t.labels.filter("quality = 0").agg(count).select(F.lit("report").alias("table"), F.lit("label").alias("column"), limit, "failures"))
        .unionByName(t.labels.filter("toxic = 1").agg(count).select(F.lit("lonely").alias("table"), F.lit("score").alias("column"), limit, "failures"))
    )
    return L.trace_to_roots(edges, report)


@query(
    """
    SELECT 'published' AS output_table, c AS output_column, 'customer' AS source_table,
           s AS source_column, kind, filled
    FROM (SELECT 'c_custkey' AS c, 'c_custkey' AS s, 'passthrough' AS kind,
                 count(c_custkey) AS filled FROM customer
          UNION ALL SELECT 'segment', 'c_mktsegment', 'rename', count(c_mktsegment) FROM customer)
    """
)
def l2_passthrough_lineage(t):
    edges = L.passthrough_lineage(
        t.spark, "published", "customer", ["c_custkey"], {"segment": "c_mktsegment"}
    )
    filled = t.customer.agg(*[F.count(c).alias(c) for c in t.customer.columns])
    counts = filled.unpivot([], filled.columns, "source_column", "filled")
    return edges.join(counts, "source_column").select(*edges.columns, "filled")


@query(
    f"""
    {WITH_SALES}
    SELECT count(*) AS record_count, CAST(sum(sale_price_usd) AS BIGINT) AS total_value,
           count(DISTINCT artwork_id) AS unique_artworks FROM sales_transform
    """
)
def l3_output_statistics(t):
    transformed = plans.sales_transform(sales(t), artworks(t), artists(t), ordered=False)
    return L.output_statistics(
        transformed,
        {
            "record_count": "count(*)",
            "total_value": "sum(sale_price_usd)",
            "unique_artworks": "count(distinct artwork_id)",
        },
    )


@query("SELECT count(*) AS record_count, sum(l_quantity) AS quantity FROM lineitem")
def l3_statistics_during_write(t):
    result = write_parquet(
        t.lineitem, fresh_path(t.spark, "lines"), metrics={"quantity": F.sum("l_quantity")}
    )
    m = result.metrics
    # the written rows are counted again only to compare with what the write saw
    return t.spark.read.parquet(result.path).agg(
        F.when(F.count(F.lit(1)) == m["record_count"], m["record_count"]).cast("long").alias("record_count"),
        F.when(F.sum("l_quantity") == m["quantity"], m["quantity"]).alias("quantity"),
    )


@query(
    f"""
    SELECT {_display_sql("c_custkey", True)} AS c_custkey, c_name,
           {_display_sql("c_nationkey", True)} AS c_nationkey, c_mktsegment AS segment,
           {_display_sql("c_acctbal", False)} AS balance
    FROM customer WHERE c_custkey = 2
    """
)
def l4_formatted_example(t):
    return L.formatted_example(
        t.customer, "c_custkey", 2, {"segment": "c_mktsegment", "balance": "c_acctbal"}
    )


@query(
    """
    SELECT count(*) AS record_count, max(p_retailprice) AS top_price, 6 AS columns,
           least(count(*), 5) AS preview_rows FROM part
    """
)
def l5_frame_profile(t):
    found = L.profile(t.part, 5, {"top_price": "max(p_retailprice)"})
    return found["preview"].agg(
        F.lit(found["record_count"]).cast("long").alias("record_count"),
        F.lit(found["top_price"]).alias("top_price"),
        F.lit(len(found["columns"])).alias("columns"),
        F.count(F.lit(1)).alias("preview_rows"),
    )


@query("SELECT count(*) AS rows FROM events")
def l6_row_count_after_write(t):
    path = fresh_path(t.spark, "events")
    write_parquet(t.events, path)
    rows = L.stored_rows(t.spark, path)
    return t.spark.read.parquet(path).agg(F.lit(rows).cast("long").alias("rows"))


def _example_sql(table, columns, where):
    return " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{name}' AS \"column\", {text} AS example "
        f"FROM {table} WHERE {where}"
        for name, text in columns.items()
    )


@query(
    _example_sql(
        "supplier",
        {
            "s_suppkey": _display_sql("s_suppkey", True),
            "s_name": "s_name",
            "s_nationkey": _display_sql("s_nationkey", True),
            "s_acctbal": _display_sql("s_acctbal", False),
        },
        "s_suppkey = 2",
    )
    + " UNION ALL "
    + _example_sql(
        "nation",
        {
            "n_nationkey": _display_sql("n_nationkey", True),
            "n_name": "n_name",
            "n_regionkey": _display_sql("n_regionkey", True),
        },
        "n_name = 'NATION_7'",
    )
)
def l7_raw_examples(t):
    return L.raw_examples(
        {"supplier": t.supplier, "nation": t.nation},
        {"supplier": ("s_suppkey", 2), "nation": ("n_name", "NATION_7")},
    )
