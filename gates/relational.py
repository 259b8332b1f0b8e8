"""Joins, aggregates, windows, sorts, comparison, SQL and chains."""

from pyspark.sql import functions as F

from gates.registry import query
from gates.roles import (
    ARTISTS,
    ARTWORKS,
    MEDIA,
    SALES,
    artists,
    artworks,
    media,
    sales,
)
from tablewright.operators.digests import RangedTable, diff_stored
from tablewright.session import fresh_path
from tablewright.operators import aggregates as A
from tablewright.operators import joins as J
from tablewright.operators import ordering as O
from tablewright.operators import windows as W
from tablewright.operators.chain import Chain, FilterStep, SqlStep, TextStep
from tablewright.operators.columns import uppercase_columns
from tablewright.operators.diff import diff_tables
from tablewright.operators.sql import SqlSteps, sql_query, sql_transform

MONEY = "decimal(18,2)"


def _money(column):
    return F.col(column).cast(MONEY)


# --- joins -----------------------------------------------------------------


@query(
    f"""
    WITH {SALES}, {ARTWORKS}, {ARTISTS}
    SELECT s.sale_id, s.artwork_id, s.sale_price_usd, a.title, r.nationality
    FROM sales s LEFT JOIN artworks a ON s.artwork_id = a.artwork_id
    LEFT JOIN artists r ON a.artist_id = r.artist_id
    """
)
def j1_left_join_chain(t):
    joined = J.join_on(sales(t), artworks(t), "artwork_id", "left")
    joined = J.join_on(joined, artists(t), "artist_id", "left")
    return joined.select("sale_id", "artwork_id", "sale_price_usd", "title", "nationality")


@query("SELECT o_orderkey, o_totalprice, c_name, c_mktsegment FROM orders "
       "JOIN customer ON o_custkey = c_custkey")
def j2_inner_join(t):
    orders = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    return J.join_on(orders, t.customer, "c_custkey").select(
        "o_orderkey", "o_totalprice", "c_name", "c_mktsegment"
    )


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def j3_semi_join(t):
    return J.semi_join(t.documents.select("doc_id", "lang"), t.labels, "doc_id")


@query("SELECT DISTINCT o_orderkey FROM orders "
       "WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def j4_anti_join(t):
    return J.orphan_keys(t.orders, t.lineitem, "o_orderkey", "l_orderkey")


@query(
    """
    SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    """
)
def j5_not_in(t):
    return J.not_in_keys(t.documents, t.labels, "doc_id")


@query(
    """
    SELECT DISTINCT doc_id FROM documents
    WHERE doc_id NOT IN (SELECT CASE WHEN toxic = 0 THEN doc_id END FROM labels)
    """
)
def j5_not_in_with_nulls(t):
    parents = t.labels.select(F.when(F.col("toxic") == 0, F.col("doc_id")).alias("doc_id"))
    return J.not_in_keys(t.documents, parents, "doc_id")


@query(
    """
    SELECT coalesce(a.conv_id, b.conv_id) AS conv_id, a.questions, b.replies
    FROM (SELECT conv_id, count(*) AS questions FROM conversations WHERE role <> 'assistant'
          GROUP BY conv_id) a
    FULL JOIN (SELECT conv_id, count(*) AS replies FROM conversations WHERE role = 'assistant'
               GROUP BY conv_id) b ON a.conv_id = b.conv_id
    """
)
def j6_full_outer_join(t):
    def counted(condition, name):
        rows = t.conversations.filter(condition)
        return A.aggregate(rows, "conv_id", {name: "count(*)"})

    questions = counted("role <> 'assistant'", "questions")
    return J.full_join(questions, counted("role = 'assistant'", "replies"), "conv_id")


@query(
    """
    SELECT a.l_orderkey, a.l_linenumber, b.o_orderstatus, c.c_name, d.n_name
    FROM lineitem a LEFT JOIN orders b ON a.l_orderkey = b.o_orderkey
    LEFT JOIN customer c ON b.o_custkey = c.c_custkey
    LEFT JOIN nation d ON c.c_nationkey = d.n_nationkey
    """
)
def j7_join_chain(t):
    return J.join_chain(
        t.lineitem,
        [
            (t.orders, "l_orderkey", "o_orderkey"),
            (t.customer, "b.o_custkey", "c_custkey"),
            (t.nation, "c.c_nationkey", "n_nationkey"),
        ],
        ["a.l_orderkey", "a.l_linenumber", "b.o_orderstatus", "c.c_name", "d.n_name"],
    )


@query(
    """
    SELECT d.doc_id AS doc_id_x, d.lang, l.doc_id AS doc_id_y, l.quality
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """
)
def j8_merge_lookup(t):
    documents = t.documents.select("doc_id", "lang")
    return J.lookup(documents, t.labels, "doc_id", "doc_id", ["doc_id", "quality"])


@query(
    """
    SELECT o_orderkey, o_custkey, lines, quantity FROM orders
    LEFT JOIN (SELECT l_orderkey AS o_orderkey, count(*) AS lines, sum(l_quantity) AS quantity
               FROM lineitem GROUP BY l_orderkey) USING (o_orderkey)
    """
)
def j9_aggregate_then_join(t):
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    return J.aggregate_then_join(
        t.orders.select("o_orderkey", "o_custkey"),
        lines,
        "o_orderkey",
        {"lines": "count(*)", "quantity": "sum(l_quantity)"},
    )


@query("SELECT doc_id, lang, quality, toxic FROM documents JOIN labels USING (doc_id)")
def j10_using_join(t):
    return J.join_on(t.documents.select("doc_id", "lang"), t.labels, "doc_id")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice, s_name FROM lineitem "
       "LEFT JOIN supplier ON l_suppkey = s_suppkey")
def j1_join_with_hot_keys_spread(t):
    # every supplier counts as hot here, so all rows take the salted route
    lines = t.lineitem.withColumnRenamed("l_suppkey", "s_suppkey").select(
        "s_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice"
    )
    suppliers = t.supplier.select("s_suppkey", "s_name")
    joined = J.spread_hot_keys(lines, suppliers, "s_suppkey", "left", hot_rows=100, salts=8)
    return joined.drop("s_suppkey")


@query("SELECT l_suppkey, count(*) AS rows FROM lineitem GROUP BY l_suppkey HAVING count(*) > 600")
def j1_frequent_keys(t):
    # fewer counters than there are suppliers on the larger tables
    return J.frequent_keys(t.lineitem, "l_suppkey", 600, counters=64)


# --- aggregates ------------------------------------------------------------


@query(
    """
    SELECT l_returnflag, l_linestatus, count(*) AS n,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS total,
           max(l_discount) AS top_discount
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    """
)
def a1_group_by(t):
    return A.aggregate(
        t.lineitem,
        ["l_returnflag", "l_linestatus"],
        {
            "n": "count(*)",
            "total": f"cast(sum(cast(l_extendedprice as {MONEY})) as double)",
            "top_discount": "max(l_discount)",
        },
    )


@query(
    f"""
    WITH {SALES}, {ARTWORKS}
    SELECT artwork_id, count(*) AS sale_count,
           CAST(sum(sale_price_usd) AS BIGINT) AS total_sales_value,
           round(avg(sale_price_usd), 0) AS avg_sale_price,
           min(sale_date) AS first_sale_date, max(sale_date) AS last_sale_date
    FROM sales WHERE artwork_id IN (SELECT artwork_id FROM artworks) GROUP BY artwork_id
    """
)
def a2_sales_per_item(t):
    known = J.semi_join(sales(t), artworks(t), "artwork_id")
    return A.sales_per_item(known, "artwork_id", "sale_price_usd", "sale_date")


@query(
    """
    SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL
    """
)
def a3_group_by_all(t):
    return sql_transform(
        t.orders,
        "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM _input GROUP BY ALL",
    )


@query(
    f"""
    WITH {MEDIA}
    SELECT artwork_id, CAST(to_json(list({{'sort_order': sort_order, 'filename': filename,
             'file_size_kb': file_size_kb, 'alt_text': alt_text}} ORDER BY sort_order)) AS VARCHAR)
             AS media
    FROM media GROUP BY artwork_id
    """
)
def a4_ordered_structs(t):
    fields = ["sort_order", "filename", "file_size_kb", "alt_text"]
    lists = A.ordered_structs(media(t), "artwork_id", "sort_order", fields, "media")
    return lists.select(
        "artwork_id", F.to_json("media", {"ignoreNullFields": "false"}).alias("media")
    )


@query(
    """
    SELECT conv_id, CAST(floor(turn / 3) AS BIGINT) AS part, count(*) AS n,
           string_agg(role, ',' ORDER BY turn) AS roles
    FROM conversations GROUP BY conv_id, floor(turn / 3)
    """
)
def a4_ordered_structs_in_parts(t):
    parts = A.ordered_struct_parts(
        t.conversations, "conv_id", ["turn"], ["turn", "role"], "items", part_rows=3
    )
    return parts.select(
        "conv_id",
        "part",
        F.size("items").cast("long").alias("n"),
        F.array_join(F.transform("items", lambda s: s["role"]), ",").alias("roles"),
    )


@query(
    f"""
    WITH {MEDIA}
    SELECT m.artwork_id, f.filename AS primary_image, f.alt_text AS primary_image_alt
    FROM (SELECT DISTINCT artwork_id FROM media) m
    LEFT JOIN (SELECT * FROM media WHERE sort_order = 2) f ON m.artwork_id = f.artwork_id
    """
)
def a5_first_where(t):
    return A.first_where(
        media(t),
        "artwork_id",
        {"primary_image": "filename", "primary_image_alt": "alt_text"},
        "sort_order = 2",
        ["filename"],
    )


@query(
    """
    SELECT s_nationkey, array_to_string(list(name ORDER BY s_suppkey), ',') AS names,
           len(list(name)) AS n
    FROM (SELECT *, CASE WHEN s_acctbal > 0 THEN s_name END AS name FROM supplier)
    GROUP BY s_nationkey
    """
)
def a6_implode(t):
    name = F.when(F.col("s_acctbal") > 0, F.col("s_name"))
    rows = t.supplier.select("s_nationkey", "s_suppkey", name.alias("name"))
    lists = A.implode(rows, "s_nationkey", "name", "s_suppkey")
    return lists.select(
        "s_nationkey", F.array_join("name", ",").alias("names"), F.size("name").cast("long").alias("n")
    )


@query(
    """
    SELECT o_orderkey, o_orderpriority,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) OVER (PARTITION BY o_orderpriority)
             AS DOUBLE) AS total
    FROM orders
    """
)
def a7_sum_by_group(t):
    orders = t.orders.select("o_orderkey", "o_orderpriority", _money("o_totalprice").alias("p"))
    total = A.group_total(orders, "o_orderpriority", "p", "total")
    return total.select("o_orderkey", "o_orderpriority", F.col("total").cast("double").alias("total"))


@query("SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def a8_value_counts(t):
    return A.value_counts(t.events, "event_type")


@query(
    """
    SELECT lang, count(DISTINCT quality) + CAST(max(quality IS NULL) AS INTEGER) AS with_null,
           count(DISTINCT quality) AS without_null, count(DISTINCT source) AS sources
    FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang
    """
)
def a9_distinct_count(t):
    joined = t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left")
    return joined.groupBy("lang").agg(
        A.distinct_count("quality").alias("with_null"),
        A.distinct_count("quality", count_null=False).alias("without_null"),
        A.distinct_count("source").alias("sources"),
    )


@query(
    """
    SELECT count(*) AS record_count, CAST(sum(price) AS DOUBLE) AS price_total,
           min(day) AS day_min, max(day) AS day_max, count(DISTINCT l_partkey) AS l_partkey_distinct,
           count(*) FILTER (WHERE returned) AS returned_true,
           count(*) FILTER (WHERE NOT returned) AS returned_false
    FROM (SELECT l_partkey, CAST(l_extendedprice AS DECIMAL(18, 2)) AS price,
                 strftime(l_shipdate, '%Y-%m-%d') AS day, l_returnflag = 'R' AS returned FROM lineitem)
    """
)
def a10_global_summary(t):
    lines = t.lineitem.select(
        "l_partkey",
        _money("l_extendedprice").alias("price"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("day"),
        (F.col("l_returnflag") == "R").alias("returned"),
    )
    row = A.summarise(lines, ["price"], ["day"], ["l_partkey"], ["returned"])
    return row.withColumn("price_total", F.col("price_total").cast("double"))


@query(
    """
    SELECT count(*) - count(quality) AS quality, count(*) - count(toxic) AS toxic,
           count(*) - count(doc_id) AS doc_id
    FROM documents LEFT JOIN labels USING (doc_id)
    """
)
def a11_null_counts(t):
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return A.null_counts(joined, ["quality", "toxic", "doc_id"])


@query(
    """
    SELECT l_suppkey, CAST(count_if(l_returnflag = 'R') AS BIGINT) AS returned,
           sum(l_quantity) FILTER (WHERE l_returnflag = 'R') AS returned_quantity
    FROM lineitem GROUP BY l_suppkey
    """
)
def a12_conditional_aggregates(t):
    return A.aggregate(
        t.lineitem,
        "l_suppkey",
        {
            "returned": "count_if(l_returnflag = 'R')",
            "returned_quantity": "sum(l_quantity) FILTER (WHERE l_returnflag = 'R')",
        },
    )


@query(
    """
    SELECT s_nationkey, string_agg(s_name, ', ' ORDER BY s_acctbal DESC, s_suppkey) AS names
    FROM supplier GROUP BY s_nationkey
    """
)
def a13_ordered_text(t):
    return A.ordered_text(
        t.supplier, "s_nationkey", "s_name", ["s_acctbal DESC", "s_suppkey"], "names"
    )


@query(
    """
    SELECT conv_id, array_to_string(list(role ORDER BY turn), '>') AS roles
    FROM conversations GROUP BY conv_id
    """
)
def a14_ordered_list(t):
    lists = A.ordered_list(t.conversations, "conv_id", "role", "turn", "roles")
    return lists.select("conv_id", F.array_join("roles", ">").alias("roles"))


_NUMBERED_SUPPLIERS = """
    SELECT *, CASE WHEN s_acctbal > 0 THEN s_name END AS name,
           row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS n,
           row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) - 1 AS m
    FROM supplier
    """


@query(
    f"""
    SELECT s_nationkey, CAST(floor(n / 4) AS BIGINT) AS part, len(list(name)) AS n,
           array_to_string(list(name ORDER BY s_suppkey), ',') AS names
    FROM ({_NUMBERED_SUPPLIERS}) GROUP BY s_nationkey, floor(n / 4)
    """
)
def a6_implode_in_parts(t):
    name = F.when(F.col("s_acctbal") > 0, F.col("s_name"))
    rows = t.supplier.select("s_nationkey", "s_suppkey", name.alias("name"))
    parts = A.list_parts(rows, "s_nationkey", "name", ["s_suppkey"], "names", part_rows=4)
    return parts.select(
        "s_nationkey", "part", F.size("names").cast("long").alias("n"), F.array_join("names", ",").alias("names")
    )


@query(
    f"""
    SELECT s_nationkey, CAST(floor(m / 4) AS BIGINT) AS part,
           string_agg(s_name, ', ' ORDER BY s_acctbal DESC, s_suppkey) AS names
    FROM ({_NUMBERED_SUPPLIERS}) GROUP BY s_nationkey, floor(m / 4)
    """
)
def a13_ordered_text_in_parts(t):
    order = ["s_acctbal desc", "s_suppkey"]
    return A.text_parts(t.supplier, "s_nationkey", "s_name", order, "names", part_rows=4, single_task_rows=10)


@query(
    """
    SELECT conv_id, CAST(floor(turn / 3) AS BIGINT) AS part,
           array_to_string(list(role ORDER BY turn), '>') AS roles
    FROM conversations GROUP BY conv_id, floor(turn / 3)
    """
)
def a14_ordered_list_in_parts(t):
    parts = A.list_parts(t.conversations, "conv_id", "role", ["turn"], "roles", part_rows=3)
    return parts.select("conv_id", "part", F.array_join("roles", ">").alias("roles"))


# --- windows ---------------------------------------------------------------


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
           rank() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC) AS place,
           count(*) OVER (PARTITION BY l_orderkey) AS n
    FROM lineitem
    """
)
def w1_window_columns(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    window = W.window_columns(
        lines,
        {
            "place": "rank() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC)",
            "n": "count(*) OVER (PARTITION BY l_orderkey)",
        },
    )
    return window.withColumn("place", F.col("place").cast("long"))


_RANKED = """
    SELECT o_orderkey, o_totalprice, rank() OVER (ORDER BY cents DESC) AS place
    FROM (SELECT *, CAST(floor(o_totalprice / 100) AS BIGINT) AS cents FROM orders)
    """


def _orders_by_hundreds(t):
    return t.orders.select(
        "o_orderkey", "o_totalprice", F.floor(F.col("o_totalprice") / 100).alias("cents")
    )


@query(_RANKED)
def w2_rank_all_rows(t):
    return W.rank_rows(_orders_by_hundreds(t), "cents", "place").drop("cents")


@query(_RANKED)
def w2_rank_all_rows_distributed(t):
    ranked = W.rank_rows(_orders_by_hundreds(t), "cents", "place", single_task_rows=1000)
    return ranked.drop("cents")


@query(
    """
    SELECT event_id, row_number() OVER (ORDER BY value DESC, event_id) AS place FROM events
    """
)
def w3_ordinal_rank_distributed(t):
    rows = t.events.select("event_id", "value")
    return W.number_rows(
        rows, ["value desc", "event_id"], "place", single_task_rows=1000
    ).drop("value")


_WITHIN = """
    SELECT event_id, event_type,
           row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS place
    FROM events
    """


@query(_WITHIN)
def w4_ordinal_rank_in_group(t):
    rows = t.events.select("event_id", "event_type", "value")
    # every type is larger than the bound, so all groups take the distributed route
    return W.number_rows(
        rows, ["value desc", "event_id"], "place", ["event_type"], single_task_rows=100
    ).drop("value")


@query(_WITHIN)
def w5_row_number_in_group(t):
    rows = t.events.select("event_id", "event_type", "value")
    return W.number_rows(rows, ["value desc", "event_id"], "place", ["event_type"]).drop("value")


@query(
    """
    SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id) AS n,
           CAST(sum(CAST(value AS DECIMAL(18, 2))) OVER (PARTITION BY user_id) AS DOUBLE) AS total
    FROM events
    """
)
def w6_group_measures(t):
    events = t.events.select("event_id", "user_id", _money("value").alias("value"))
    measured = W.group_measures(events, "user_id", {"n": "count(*)", "total": "sum(value)"})
    return measured.select("event_id", "user_id", "n", F.col("total").cast("double").alias("total"))


_RUNNING = """
    SELECT o_orderkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) OVER (ORDER BY o_orderdate)
             AS DOUBLE) AS running
    FROM orders
    """


def _running(t, **kwargs):
    orders = t.orders.select("o_orderkey", "o_orderdate", _money("o_totalprice").alias("price"))
    total = W.running_total(orders, "o_orderdate", {"running": "price"}, **kwargs)
    return total.select("o_orderkey", F.col("running").cast("double").alias("running"))


@query(_RUNNING)
def w7_running_total(t):
    return _running(t)


@query(_RUNNING)
def w7_running_total_distributed(t):
    return _running(t, single_task_rows=100)


@query(
    """
    SELECT o_orderkey, o_orderpriority,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2)))
             OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate) AS DOUBLE) AS running
    FROM orders
    """
)
def w7_running_total_in_group(t):
    orders = t.orders.select(
        "o_orderkey", "o_orderpriority", "o_orderdate", _money("o_totalprice").alias("price")
    )
    total = W.running_total(
        orders, "o_orderdate", {"running": "price"}, ["o_orderpriority"], single_task_rows=100
    )
    return total.select(
        "o_orderkey", "o_orderpriority", F.col("running").cast("double").alias("running")
    )


_SPARSE = """
    SELECT o_orderkey, CAST(sum(CASE WHEN o_orderdate >= DATE '1993-01-01' AND o_orderkey % 3 > 0
             THEN CAST(o_totalprice AS DECIMAL(18, 2)) END)
             OVER ({}ORDER BY o_orderdate) AS DOUBLE) AS running
    FROM orders
    """


def _running_with_nulls(t, groups=(), **kwargs):
    # nothing in the first year, and nothing in every third row after it
    counts = (F.col("o_orderdate") >= F.lit("1993-01-01")) & (F.col("o_orderkey") % 3 > 0)
    orders = t.orders.select(
        "o_orderkey", "o_orderdate", *groups, F.when(counts, _money("o_totalprice")).alias("price")
    )
    total = W.running_total(orders, "o_orderdate", {"running": "price"}, groups, **kwargs)
    return total.select("o_orderkey", F.col("running").cast("double").alias("running"))


@query(_SPARSE.format(""))
def w7_running_total_with_nulls(t):
    return _running_with_nulls(t)


@query(_SPARSE.format(""))
def w7_running_total_with_nulls_distributed(t):
    return _running_with_nulls(t, single_task_rows=100)


@query(_SPARSE.format("PARTITION BY o_orderpriority "))
def w7_running_total_with_nulls_in_group(t):
    return _running_with_nulls(t, ["o_orderpriority"], single_task_rows=100)


# --- sorts, limits, sets ---------------------------------------------------


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders "
       "ORDER BY o_orderdate DESC, o_orderkey")
def o1_mixed_sort(t):
    return O.sort_rows(t.orders, "o_orderdate desc", "o_orderkey").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")
    )


@query("SELECT * FROM region ORDER BY r_regionkey LIMIT 5")
def o2_preview(t):
    return O.preview(O.sort_rows(t.region, "r_regionkey"), 5)


@query(
    """
    SELECT l_partkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
    FROM lineitem GROUP BY l_partkey ORDER BY total DESC, l_partkey LIMIT 5
    """
)
def o3_top_by_value(t):
    totals = t.lineitem.groupBy("l_partkey").agg(F.sum(_money("l_extendedprice")).alias("total"))
    top = O.top_rows(totals, 5, "total desc", "l_partkey")
    return top.select("l_partkey", F.col("total").cast("double").alias("total"))


@query("SELECT * FROM customer WHERE c_custkey = 2")
def o4_example_row(t):
    return O.example_row(t.customer, "c_custkey", 2)


@query("SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def u1_distinct_rows(t):
    return O.distinct_rows(t.lineitem, ["l_returnflag", "l_linestatus"])


@query(
    """
    SELECT coalesce(a.lang, b.lang) AS lang, coalesce(a.source, b.source) AS source,
           coalesce(a.n, 0) AS left_count, coalesce(b.n, 0) AS right_count
    FROM (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL) a
    FULL JOIN (SELECT lang, source, count(*) AS n FROM documents JOIN labels USING (doc_id)
               GROUP BY ALL) b ON a.lang = b.lang AND a.source = b.source
    WHERE coalesce(a.n, 0) != coalesce(b.n, 0)
    """
)
def u2_table_diff(t):
    documents = t.documents.select("doc_id", "lang", "source")
    labelled = J.semi_join(documents, t.labels, "doc_id")
    return diff_tables(documents.drop("doc_id"), labelled.drop("doc_id")).rows


# --- SQL and chains --------------------------------------------------------


@query(
    """
    SELECT l_orderkey, l_quantity * 2 AS doubled, p_name FROM lineitem
    JOIN part ON l_partkey = p_partkey WHERE l_discount > 0.05
    """
)
def p8_sql_transform(t):
    return sql_transform(
        t.lineitem,
        "SELECT l_orderkey, l_quantity * 2 AS doubled, p_name FROM _input "
        "JOIN part ON l_partkey = p_partkey WHERE l_discount > 0.05",
        {"part": t.part},
    )


@query(
    """
    SELECT n_name, count(*) AS customers FROM customer
    JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name
    """
)
def p9_sql_query(t):
    SqlSteps(t.spark).view("gate_customer", t.customer).view("gate_nation", t.nation)
    return sql_query(
        t.spark,
        "SELECT n_name, count(*) AS customers FROM gate_customer "
        "JOIN gate_nation ON c_nationkey = n_nationkey GROUP BY n_name",
    )


@query(
    """
    WITH totals AS (SELECT l_orderkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_orderkey)
    SELECT o_orderpriority, count(*) AS orders, sum(quantity) AS quantity
    FROM orders JOIN totals ON o_orderkey = l_orderkey GROUP BY o_orderpriority
    """
)
def p12_sql_steps(t):
    steps = SqlSteps(t.spark).view("gate_lines", t.lineitem).view("gate_orders", t.orders)
    steps.step(
        "gate_totals",
        "SELECT l_orderkey, sum(l_quantity) AS quantity FROM gate_lines GROUP BY l_orderkey",
        keep=True,
    )
    steps.step(
        "gate_priorities",
        "SELECT o_orderpriority, count(*) AS orders, sum(quantity) AS quantity "
        "FROM gate_orders JOIN gate_totals ON o_orderkey = l_orderkey GROUP BY o_orderpriority",
    )
    return steps.result("gate_priorities")


@query(
    """
    SELECT upper(trim(c_name)) AS c_name, c_acctbal, c_acctbal * 2 AS doubled
    FROM customer WHERE c_acctbal >= 1000
    """
)
def c1_chain(t):
    chain = Chain(
        [
            TextStep("c_name", "strip"),
            TextStep("c_name", "upper"),
            FilterStep("c_acctbal", 1000, ">="),
            SqlStep("SELECT c_name, c_acctbal, c_acctbal * 2 AS doubled FROM _input"),
        ]
    )
    return chain.apply(t.customer)


@query("SELECT c_custkey, c_acctbal + 1 AS c_acctbal FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9000")
def c2_custom_steps(t):
    class Bump:
        def apply(self, df):
            return df.withColumn("c_acctbal", F.col("c_acctbal") + 1)

    def extremes(df):
        return df.filter("c_acctbal < 0 OR c_acctbal > 9000").select("c_custkey", "c_acctbal")

    return Chain([extremes, Bump()]).apply(t.customer)


@query("SELECT p_partkey, upper(p_name) AS p_name, upper(p_type) AS p_type FROM part")
def c3_uppercase_columns(t):
    return uppercase_columns(t.part.select("p_partkey", "p_name", "p_type"), "p_name", "p_type")


_CHANGED = """
    SELECT * REPLACE (CASE WHEN o_orderkey % 997 = 3 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice)
    FROM orders WHERE o_orderkey % 1009 <> 5 UNION ALL SELECT * FROM orders WHERE o_orderkey % 1013 = 7"""


@query(
    f"""
    SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, coalesce(a.o_totalprice, b.o_totalprice) AS o_totalprice,
           coalesce(a.n, 0) AS left_count, coalesce(b.n, 0) AS right_count
    FROM (SELECT o_orderkey, o_totalprice, count(*) AS n FROM orders GROUP BY ALL) a
    FULL JOIN (SELECT o_orderkey, o_totalprice, count(*) AS n FROM ({_CHANGED}) GROUP BY ALL) b
      ON a.o_orderkey = b.o_orderkey AND a.o_totalprice = b.o_totalprice
    WHERE coalesce(a.n, 0) != coalesce(b.n, 0)
    """
)
def u2_diff_by_digests(t):
    """Orders and a copy with some rows changed, lost or repeated: only their ranges are read again."""
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    changed = t.orders.filter(key % 1009 != 5).withColumn("o_totalprice", F.when(key % 997 == 3, price + 1).otherwise(price))
    changed = changed.unionByName(t.orders.filter(key % 1013 == 7))
    tables = []
    for df in (t.orders, changed):
        table = RangedTable(t.spark, fresh_path(t.spark, "ranged"), df.schema, ["o_orderkey"], ranges=64, fan=4)
        table.write(df)
        tables.append(table)
    diff, _ = diff_stored(*tables)
    return diff.rows.select("o_orderkey", "o_totalprice", "left_count", "right_count")
