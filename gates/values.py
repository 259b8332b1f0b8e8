"""Scalar, list and struct values. List results are shown as text."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gates.registry import query
from tablewright import functions as E
from tablewright.operators.columns import structs_from_columns, transform_text

# every character with the Unicode property White_Space
SPACE = r"[\t\n\x0b\f\r\x{85}\p{Z}]+"


@query(
    """
    SELECT o_orderkey, upper(o_orderpriority) AS up, lower(o_orderpriority) AS low FROM orders
    """
)
def e1_upper_lower(t):
    return t.orders.select(
        "o_orderkey", E.upper("o_orderpriority").alias("up"), E.lower("o_orderpriority").alias("low")
    )


@query(
    r"""
    SELECT conv_id, turn, array_to_string(list_transform(
             regexp_extract_all(text, '[\p{L}\p{N}]+|[^\p{L}\p{N}]+'),
             lambda w: upper(replace(w[1], 'ß', 'SS')) || lower(w[2:])), '') AS text
    FROM conversations
    """
)
def e2_title_case(t):
    return transform_text(t.conversations.select("conv_id", "turn", "text"), "text", "title")


@query(
    rf"""
    SELECT doc_id, regexp_replace(padded, '^{SPACE}|{SPACE}$', '', 'g') AS both,
           regexp_replace(padded, '^{SPACE}', '') AS left_only,
           regexp_replace(padded, '{SPACE}$', '') AS right_only,
           trim(lang || '--', '-') AS dashes
    FROM (SELECT doc_id, lang, chr(9) || text || chr(160) || ' ' || chr(10) AS padded
          FROM documents)
    """
)
def e3_strip(t):
    padded = F.concat(F.lit("\t"), "text", F.lit("  \n"))
    return t.documents.select("doc_id", "lang", padded.alias("padded")).select(
        "doc_id",
        E.strip("padded").alias("both"),
        E.strip("padded", side="left").alias("left_only"),
        E.strip("padded", side="right").alias("right_only"),
        E.strip(F.concat("lang", F.lit("--")), "-").alias("dashes"),
    )


@query("SELECT p_partkey, upper(p_name[1]) || lower(p_name[2:]) AS title FROM part")
def e4_capitalize(t):
    return t.part.select("p_partkey", E.capitalize("p_name").alias("title"))


@query(
    """
    SELECT doc_id, 'Q-' || CAST(quality AS VARCHAR) AS tagged, source || '.txt' AS filename
    FROM documents LEFT JOIN labels USING (doc_id)
    """
)
def e5_prepend_append(t):
    joined = t.documents.select("doc_id", "source").join(t.labels, "doc_id", "left")
    return joined.select(
        "doc_id",
        E.prepend_text(F.col("quality").cast("string"), "Q-").alias("tagged"),
        E.append_text("source", ".txt").alias("filename"),
    )


@query(
    """
    SELECT doc_id, concat(lang, ' ', coalesce(CAST(quality AS VARCHAR), 'None')) AS label
    FROM documents LEFT JOIN labels USING (doc_id)
    """
)
def e6_concat(t):
    joined = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return joined.select("doc_id", E.concat_columns("lang", "quality").alias("label"))


@query(
    """
    SELECT doc_id, concat_ws('/', lang, CAST(quality AS VARCHAR), source) AS label
    FROM documents LEFT JOIN labels USING (doc_id)
    """
)
def e7_concat_skip_nulls(t):
    joined = t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left")
    return joined.select(
        "doc_id", E.concat_present("lang", "quality", "source", sep="/").alias("label")
    )


@query(
    """
    SELECT page_id, len(parts) AS n, parts[3] AS host, array_to_string(parts, ' | ') AS parts
    FROM (SELECT page_id, string_split(url, '/') AS parts FROM pages)
    """
)
def e8_split(t):
    parts = t.pages.select("page_id", E.split_text("url", "/").alias("parts"))
    return parts.select(
        "page_id",
        F.size("parts").cast("long").alias("n"),
        F.get("parts", F.lit(2)).alias("host"),
        F.array_join("parts", " | ").alias("parts"),
    )


@query(
    r"""
    SELECT page_id, CASE WHEN regexp_matches(url, '/([0-9]+)\?')
             THEN regexp_extract(url, '/([0-9]+)\?', 1) END AS number,
           regexp_extract(url, '/([0-9]+)\?', 1) AS number_or_empty
    FROM pages
    """
)
def e9_regex_extract(t):
    return t.pages.select(
        "page_id",
        E.extract_pattern("url", r"/([0-9]+)\?").alias("number"),
        E.extract_pattern("url", r"/([0-9]+)\?", no_match="").alias("number_or_empty"),
    )


@query(
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE o_orderstatus END AS named,
           nullif(o_orderstatus, 'P') AS blanked
    FROM orders
    """
)
def e10_replace_value(t):
    return t.orders.select(
        "o_orderkey",
        E.replace_value("o_orderstatus", "P", "pending").alias("named"),
        E.replace_value("o_orderstatus", "P", None).alias("blanked"),
    )


@query(
    rf"SELECT doc_id, regexp_replace(text, '{SPACE}', ' ', 'g') AS text, "
    r"regexp_replace(source, '[0-9]+', '#', 'g') AS source FROM documents"
)
def e11_regex_replace(t):
    return t.documents.select(
        "doc_id",
        E.collapse_whitespace("text").alias("text"),
        E.replace_pattern("source", "[0-9]+", "#").alias("source"),
    )


@query("SELECT s_suppkey, upper(s_name) AS name FROM supplier")
def e12_normalise_name(t):
    padded = F.concat(F.lit(" \t"), F.lower("s_name"), F.lit("\n"))
    return t.supplier.select("s_suppkey", E.normalise_name(padded).alias("name"))


_DISPLAY = """
CASE WHEN {c} IS NULL THEN NULL
     WHEN abs({c}) >= 1000000 THEN {s} || '$' || format('{{:.1f}}', abs({c}) / 1000000.0e0) || 'M'
     WHEN abs({c}) >= 1000 THEN {s} || '$' || format('{{:.1f}}', abs({c}) / 1000.0e0) || 'K'
     ELSE {small} END"""


def _display_sql(column: str, whole: bool) -> str:
    sign = f"CASE WHEN {column} < 0 THEN '-' ELSE '' END"
    small = (
        f"CAST({column} AS VARCHAR)"
        if whole
        else f"{sign} || '$' || format('{{:.2f}}', abs({column}))"
    )
    return _DISPLAY.format(c=column, s=sign, small=small)


@query(
    f"""
    SELECT o_orderkey, {_display_sql("price", False)} AS price, {_display_sql("cents", True)} AS cents
    FROM (SELECT o_orderkey, o_totalprice - 1000 AS price,
                 CAST(floor(o_totalprice) AS BIGINT) * (o_orderkey % 40) - 500 AS cents FROM orders)
    """
)
def e13_display_format(t):
    numbers = t.orders.select(
        "o_orderkey",
        (F.col("o_totalprice") - 1000).alias("price"),
        (F.floor("o_totalprice") * (F.col("o_orderkey") % 40) - 500).alias("cents"),
    )
    return numbers.select(
        "o_orderkey",
        E.display_value("price", T.DoubleType()).alias("price"),
        E.display_value("cents", T.LongType()).alias("cents"),
    )


@query(
    """
    SELECT doc_id, coalesce(CAST(toxic AS VARCHAR), lang) AS flag, coalesce(quality, 0) AS quality
    FROM documents LEFT JOIN labels USING (doc_id)
    """
)
def e14_fill_empty(t):
    joined = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return joined.select(
        "doc_id",
        E.fill_empty(F.col("toxic").cast("string"), F.col("lang")).alias("flag"),
        E.fill_empty("quality", 0).alias("quality"),
    )


@query(
    """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_returnflag = 'R' THEN l_extendedprice END AS returned,
           CASE WHEN l_discount > 0.08 THEN 'deep' WHEN l_discount > 0.04 THEN 'some' END AS discount
    FROM lineitem
    """
)
def e15_extract_on_condition(t):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        E.extract_when((F.col("l_returnflag") == "R", F.col("l_extendedprice"))).alias("returned"),
        E.extract_when(
            (F.col("l_discount") > 0.08, "deep"), (F.col("l_discount") > 0.04, "some")
        ).alias("discount"),
    )


@query(
    """
    SELECT doc_id, CASE WHEN quality < 1 THEN -1 ELSE quality END AS quality,
           CASE WHEN lang != 'en' THEN 'other' ELSE lang END AS lang
    FROM documents LEFT JOIN labels USING (doc_id)
    """
)
def e16_replace_on_condition(t):
    joined = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return joined.select(
        "doc_id",
        E.replace_when("quality", "<", 1, -1).alias("quality"),
        E.replace_when("lang", "!=", "en", "other").alias("lang"),
    )


@query("SELECT p_partkey, p_size + 1 AS next_size, p_size - 1 AS prev_size FROM part")
def e17_add_subtract(t):
    return t.part.select(
        "p_partkey",
        E.add_number("p_size", 1).alias("next_size"),
        E.subtract_number("p_size", 1).alias("prev_size"),
    )


@query("SELECT l_orderkey, l_partkey, l_extendedprice - p_retailprice AS diff "
       "FROM lineitem JOIN part ON l_partkey = p_partkey")
def e18_price_difference(t):
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        "l_orderkey", "l_partkey", E.price_difference("l_extendedprice", "p_retailprice").alias("diff")
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CAST(round(CAST(CAST((l_extendedprice - base) * CAST(100 AS DOUBLE) / nullif(base, 0)
             AS VARCHAR) AS DECIMAL(38, 20)), 1) AS DOUBLE) AS pct
    FROM (SELECT *, l_quantity - 1 AS base FROM lineitem)
    """
)
def e19_percent_change(t):
    # a quantity of one gives a base of zero
    lines = t.lineitem.withColumn("base", F.col("l_quantity") - 1)
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        E.percent_change("l_extendedprice", "base").alias("pct"),
    )


@query(
    """
    SELECT p_partkey, CASE WHEN price < 933 THEN 'budget' WHEN price < 966 THEN 'mid'
             ELSE 'premium' END AS tier,
           CASE WHEN price <= 933 THEN 'budget' WHEN price <= 966 THEN 'mid'
             ELSE 'premium' END AS tier_inclusive
    FROM (SELECT p_partkey, CASE WHEN p_size != 7 THEN p_retailprice END AS price FROM part)
    """
)
def e20_price_tier(t):
    price = F.when(F.col("p_size") != 7, F.col("p_retailprice"))
    parts = t.part.select("p_partkey", price.alias("price"))
    return parts.select(
        "p_partkey",
        E.price_tier("price", (933, 966)).alias("tier"),
        E.price_tier("price", (933, 966), inclusive=True).alias("tier_inclusive"),
    )


@query(
    """
    SELECT page_id, TRY_CAST(regexp_extract(url, '([0-9]+)', 1) AS BIGINT) AS number,
           TRY_CAST(url AS INTEGER) AS bad, CAST(page_id AS DOUBLE) AS as_double
    FROM pages
    """
)
def e21_cast(t):
    return t.pages.select(
        "page_id",
        E.cast_column(F.regexp_extract("url", "([0-9]+)", 1), "bigint", strict=False).alias("number"),
        E.cast_column("url", "int", strict=False).alias("bad"),
        E.cast_column("page_id", "double").alias("as_double"),
    )


@query(
    """
    SELECT doc_id, n_chars / CAST((SELECT max(n_chars) FROM documents) AS DOUBLE) * 0.5 + 0.5
             AS priority
    FROM documents
    """
)
def e22_priority_scaling(t):
    documents = t.documents.select("doc_id", "n_chars")
    return documents.select("doc_id", E.scale_to_priority(documents, "n_chars").alias("priority"))


@query(
    """
    SELECT event_id, CASE event_type WHEN 'click' THEN 'daily' WHEN 'view' THEN 'weekly'
             ELSE event_type END AS frequency,
           CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 7 ELSE 30 END AS days
    FROM events
    """
)
def e23_value_map(t):
    return t.events.select(
        "event_id",
        E.map_values("event_type", {"click": "daily", "view": "weekly"}).alias("frequency"),
        E.map_values("event_type", {"click": 1, "view": 7}, 30, keep_unmapped=False).alias("days"),
    )


_TAGS = "CASE WHEN quality = 1 THEN ['a', NULL, lang] WHEN quality = 0 THEN [NULL, NULL] END"


def _tagged(t):
    joined = t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left")
    missing = F.lit(None).cast("string")
    tags = F.when(F.col("quality") == 1, F.array(F.lit("a"), missing, "lang")).when(
        F.col("quality") == 0, F.array(missing, missing)
    )
    return joined.withColumn("tags", tags)


@query(
    f"""
    SELECT doc_id, array_to_string(kept, ',') AS kept, kept IS NULL AS is_null
    FROM (SELECT doc_id, nullif(list_filter({_TAGS}, lambda x: x IS NOT NULL), []) AS kept
          FROM documents LEFT JOIN labels USING (doc_id))
    """
)
def e24_remove_list_nulls(t):
    kept = _tagged(t).select("doc_id", E.remove_nulls("tags").alias("kept"))
    return kept.select(
        "doc_id", F.array_join("kept", ",").alias("kept"), F.isnull("kept").alias("is_null")
    )


@query(
    """
    SELECT page_id, queries[1] AS first_query
    FROM (SELECT page_id, list_filter(string_split(url, '&'), lambda x: contains(x, 'ref'))
            AS queries FROM pages)
    """
)
def e25_first_of_list(t):
    found = F.filter(F.split("url", "&"), lambda x: F.contains(x, F.lit("ref")))
    return t.pages.select("page_id", E.first_element(found).alias("first_query"))


@query(
    f"""
    SELECT doc_id, array_to_string(list_concat(list_concat({_TAGS}, [lang]), [source]), ',') AS tags
    FROM documents LEFT JOIN labels USING (doc_id)
    """
)
def e26_append_columns(t):
    tags = _tagged(t).select("doc_id", E.append_columns("tags", "lang", "source").alias("tags"))
    return tags.select("doc_id", F.array_join("tags", ",").alias("tags"))


@query(
    """
    SELECT p_partkey, array_to_string(CASE WHEN p_size > 25 THEN list_append(words, p_brand)
             ELSE words END, '|') AS words
    FROM (SELECT *, string_split(p_name, ' ') AS words FROM part)
    """
)
def e27_append_on_condition(t):
    words = E.append_when(F.col("p_size") > 25, F.split("p_name", " "), "p_brand")
    return t.part.select("p_partkey", F.array_join(words, "|").alias("words"))


@query("SELECT s_suppkey, len([s_name]) AS n, [s_name][1] AS name FROM supplier")
def e28_ensure_list(t):
    lists = t.supplier.select("s_suppkey", E.as_list("s_name").alias("names"))
    return lists.select(
        "s_suppkey", F.size("names").cast("long").alias("n"), F.get("names", F.lit(0)).alias("name")
    )


@query(
    f"""
    SELECT doc_id, len(filled) AS n, len(list_filter(filled, lambda x: x IS NULL)) AS nulls
    FROM (SELECT doc_id, coalesce({_TAGS}, list_transform(string_split(source, 'c'), lambda x: NULL))
            AS filled
          FROM documents LEFT JOIN labels USING (doc_id))
    """
)
def e29_fill_missing_lists(t):
    rows = _tagged(t).withColumn("parts", F.split("source", "c"))
    filled = rows.select("doc_id", E.fill_missing_list("tags", "parts").alias("filled"))
    return filled.select(
        "doc_id",
        F.size("filled").cast("long").alias("n"),
        F.size(F.filter("filled", F.isnull)).cast("long").alias("nulls"),
    )


@query(
    """
    SELECT p_partkey, 1 AS n, p_size AS s, p_brand AS b, p_type AS kind FROM part
    """
)
def e30_columns_to_structs(t):
    parts = t.part.select("p_partkey", "p_size", "p_brand", "p_type")
    packed = structs_from_columns(parts, {"s": "p_size", "b": "p_brand", "kind": "p_type"}, "dims")
    assert packed.columns == ["p_partkey", "dims"]
    first = F.get("dims", F.lit(0))
    return packed.select(
        "p_partkey", F.size("dims").alias("n"), *[first[f].alias(f) for f in ("s", "b", "kind")]
    )


@query(
    """
    SELECT p_partkey, array_to_string(list_transform(list_zip(words, upper_words),
             lambda z: z[1] || '=' || z[2]), ',') AS pairs
    FROM (SELECT p_partkey, string_split(p_name, ' ') AS words,
                 string_split(upper(p_name), ' ') AS upper_words FROM part)
    """
)
def e31_zip_structs(t):
    lists = t.part.select(
        "p_partkey",
        F.split("p_name", " ").alias("words"),
        F.split(F.upper("p_name"), " ").alias("upper_words"),
    )
    zipped = lists.select("p_partkey", E.zip_structs({"w": "words", "u": "upper_words"}).alias("z"))
    pairs = F.transform("z", lambda s: F.concat_ws("=", s["w"], s["u"]))
    return zipped.select("p_partkey", F.array_join(pairs, ",").alias("pairs"))


@query(
    f"""
    SELECT doc_id, coalesce(len({_TAGS}), 0) AS n
    FROM documents LEFT JOIN labels USING (doc_id)
    """
)
def e33_list_length(t):
    return _tagged(t).select("doc_id", E.list_length("tags").cast("long").alias("n"))


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def e34_year(t):
    return t.orders.select("o_orderkey", E.year_of("o_orderdate").alias("year"))


@query(
    """
    SELECT o_orderkey, strftime(o_orderdate, '%d.%m.%Y') AS day, CAST(NULL AS VARCHAR) AS bad
    FROM orders
    """
)
def e35_text_to_date(t):
    text = t.orders.select("o_orderkey", "o_orderstatus", E.iso_date("o_orderdate").alias("text"))
    return text.select(
        "o_orderkey",
        F.date_format(E.to_date_value("text"), "dd.MM.yyyy").alias("day"),
        E.to_date_value("o_orderstatus", strict=False).cast("string").alias("bad"),
    )


@query("SELECT doc_id, replace(text, 'the', 'THE') AS text FROM documents")
def e36_substring_replace(t):
    return t.documents.select("doc_id", E.replace_text("text", "the", "THE").alias("text"))


@query("SELECT doc_id, left(text, 1) AS initial FROM documents")
def e37_first_character(t):
    return t.documents.select("doc_id", E.first_character("text").alias("initial"))


@query(
    """
    SELECT p_partkey, 2024 - year AS age,
           CASE WHEN year < 1925 THEN 'early' ELSE 'late' END AS period
    FROM (SELECT p_partkey, nullif(p_size, 7) + 1900 AS year FROM part)
    """
)
def e38_age_and_bucket(t):
    year = F.nullif("p_size", F.lit(7)) + 1900
    parts = t.part.select("p_partkey", year.alias("year"))
    return parts.select(
        "p_partkey",
        E.age_in_years("year", 2024).alias("age"),
        E.bucket_label("year", 1925, "early", "late").alias("period"),
    )
