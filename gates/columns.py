"""Column shaping, filters and predicates."""

from pyspark.sql import functions as F

from gates.registry import query
from tablewright.functions import contains_text, flag_when, is_empty, is_not_empty, matches_pattern
from tablewright.operators import columns as C
from tablewright.operators import filters


@query("SELECT c_custkey AS id, c_name AS customer, c_mktsegment FROM customer")
def p1_rename(t):
    df = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return C.rename(df, {"c_custkey": "id", "c_name": "customer"})


@query("SELECT c_mktsegment, c_custkey FROM customer")
def p2_keep_only(t):
    return C.keep_only(t.customer, ["c_mktsegment", "c_custkey"])


@query("SELECT * EXCLUDE (c_acctbal, c_nationkey) FROM customer")
def p3_drop_columns(t):
    return C.drop_columns(t.customer, ["c_acctbal", "c_nationkey"])


@query("SELECT doc_id, lang FROM documents")
def p4_drop_null_columns(t):
    # never is null in every row: no document has a negative length
    never = F.when(F.col("n_chars") < 0, F.col("source"))
    return C.drop_null_columns(t.documents.select("doc_id", never.alias("never"), "lang"))


@query("SELECT *, p_name AS display_name FROM part")
def p5_copy_column(t):
    return C.copy_column(t.part, "p_name", "display_name")


@query("SELECT *, 'catalogue' AS origin FROM supplier")
def p6_constant_column(t):
    return C.add_constant(t.supplier, "origin", "catalogue")


@query("SELECT * EXCLUDE (o_totalprice), o_totalprice AS total FROM orders")
def p7_exclude_and_rename(t):
    return C.move_renamed_last(t.orders, {"o_totalprice": "total"})


@query("SELECT * REPLACE (upper(c_name) AS c_name, c_nationkey + 1 AS c_nationkey) FROM customer")
def p13_replace_in_star(t):
    return C.replace_in_place(
        t.customer, {"c_name": "upper(c_name)", "c_nationkey": "c_nationkey + 1"}
    )


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity < 10")
def f1_numeric_filter(t):
    df = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return filters.filter_number(df, "l_quantity", 10, "<")


@query(
    """
    SELECT o_orderkey, status, o_totalprice
    FROM (SELECT *, nullif(o_orderstatus, 'P') AS status FROM orders)
    WHERE status != 'F' AND o_totalprice >= 100000
    """
)
def f2_drop_rows(t):
    orders = t.orders.select(
        "o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), "o_totalprice"
    )
    return filters.drop_rows(orders, "status = 'F' OR o_totalprice < 100000")


@query("SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_extendedprice >= 90000")
def f3_high_value(t):
    df = t.lineitem.select("l_orderkey", "l_extendedprice")
    return filters.high_value(df, "l_extendedprice", 90_000)


@query(
    """
    SELECT c_custkey, (c_acctbal > 5000 AND c_mktsegment = 'BUILDING') AS is_premium
    FROM customer
    """
)
def f4_conditional_flag(t):
    flag = flag_when("c_acctbal > 5000 AND c_mktsegment = 'BUILDING'")
    return t.customer.select("c_custkey", flag.alias("is_premium"))


@query(
    """
    SELECT doc_id, quality IS NULL AS missing_label, quality IS NOT NULL AS has_label
    FROM documents LEFT JOIN labels USING (doc_id)
    """
)
def f5_is_empty(t):
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return joined.select(
        "doc_id",
        is_empty("quality").alias("missing_label"),
        is_not_empty("quality").alias("has_label"),
    )


@query(
    r"""
    SELECT doc_id, contains(text, 'the') AS has_text,
           regexp_matches(text, '[0-9]{3}-[0-9]{4}') AS has_pattern
    FROM documents
    """
)
def f6_contains(t):
    return t.documents.select(
        "doc_id",
        contains_text("text", "the").alias("has_text"),
        matches_pattern("text", "[0-9]{3}-[0-9]{4}").alias("has_pattern"),
    )


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase')")
def f7_membership(t):
    df = t.events.select("event_id", "event_type")
    return filters.keep_members(df, "event_type", ["click", "purchase"])


@query("SELECT doc_id, quality FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL")
def f8_drop_nulls(t):
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return filters.drop_nulls(joined.select("doc_id", "quality"), "quality")


@query(
    """
    SELECT p_partkey, word FROM (
      SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part)
    """
)
def e32_explode(t):
    lists = t.part.select("p_partkey", F.split("p_name", " ").alias("word"))
    return C.explode_list(lists, "word")


@query(
    """
    SELECT doc_id, unnest(CASE WHEN quality = 1 THEN [lang, source] ELSE [NULL] END) AS tag
    FROM documents LEFT JOIN labels USING (doc_id)
    """
)
def e32_explode_keep_empty(t):
    joined = t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left")
    tags = F.when(F.col("quality") == 1, F.array("lang", "source")).otherwise(
        F.when(F.col("quality") == 0, F.array().cast("array<string>"))
    )
    return C.explode_list(joined.select("doc_id", tags.alias("tag")), "tag", keep_empty=True)
