"""The given tables in the roles that the plans expect, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gates.registry import Tables

BOUNDS = (10_000, 30_000)
HIGH_VALUE = 90_000


def sales(t: Tables) -> DataFrame:
    return t.lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sale_id"),
        F.col("l_partkey").alias("artwork_id"),
        F.col("l_shipdate").cast("date").cast("string").alias("sale_date"),
        F.floor("l_extendedprice").alias("sale_price_usd"),
        F.col("l_returnflag").alias("buyer_country"),
    )


SALES = """
sales AS (
  SELECT l_orderkey * 10 + l_linenumber AS sale_id, l_partkey AS artwork_id,
         strftime(l_shipdate, '%Y-%m-%d') AS sale_date,
         CAST(floor(l_extendedprice) AS BIGINT) AS sale_price_usd,
         l_returnflag AS buyer_country
  FROM lineitem)"""


def artworks(t: Tables) -> DataFrame:
    size = F.col("p_size")
    return t.part.select(
        F.col("p_partkey").alias("artwork_id"),
        F.col("p_name").alias("title"),
        (F.col("p_partkey") % 120).alias("artist_id"),
        (F.nullif(size, F.lit(7)) + 1900).cast("double").alias("year"),
        F.col("p_type").alias("medium"),
        (F.floor("p_retailprice") * (F.nullif(size, F.lit(3)) - 1)).alias("price_usd"),
    )


ARTWORKS = """
artworks AS (
  SELECT p_partkey AS artwork_id, p_name AS title, p_partkey % 120 AS artist_id,
         CAST(nullif(p_size, 7) + 1900 AS DOUBLE) AS year, p_type AS medium,
         CAST(floor(p_retailprice) AS BIGINT) * (nullif(p_size, 3) - 1) AS price_usd
  FROM part)"""


def artists(t: Tables) -> DataFrame:
    nations = t.nation.select("n_nationkey", F.col("n_name").alias("nationality"))
    return t.supplier.join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("s_suppkey").alias("artist_id"),
        F.concat(F.lit("  "), F.lower("s_name"), F.lit("\t")).alias("name"),
        "nationality",
    )


ARTISTS = """
artists AS (
  SELECT s_suppkey AS artist_id, '  ' || lower(s_name) || chr(9) AS name, n_name AS nationality
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey)"""


def media(t: Tables) -> DataFrame:
    """Each conversation is an artwork's list of media, each turn one of them."""
    return t.conversations.select(
        F.col("conv_id").alias("artwork_id"),
        (F.col("turn") + 1).cast("int").alias("sort_order"),
        F.concat_ws("-", "conv_id", F.concat("turn", F.lit(".jpg"))).alias("filename"),
        F.col("role").alias("media_type"),
        F.lit("jpg").alias("file_format"),
        F.length("text").alias("width_px"),
        (F.col("turn") * 10).cast("int").alias("height_px"),
        F.nullif(F.length("text") % 50, F.lit(0)).cast("int").alias("file_size_kb"),
        F.col("text").alias("alt_text"),
    )


MEDIA = """
media AS (
  SELECT conv_id AS artwork_id, CAST(turn + 1 AS INTEGER) AS sort_order,
         conv_id || '-' || turn || '.jpg' AS filename, role AS media_type,
         'jpg' AS file_format, CAST(length(text) AS INTEGER) AS width_px,
         CAST(turn * 10 AS INTEGER) AS height_px,
         CAST(nullif(length(text) % 50, 0) AS INTEGER) AS file_size_kb, text AS alt_text
  FROM conversations)"""

# half away from zero on the decimal text of a double, as Spark rounds
ROUND_1 = "CAST(round(CAST(CAST({0} AS VARCHAR) AS DECIMAL(38, 20)), 1) AS DOUBLE)"
PERCENT = ROUND_1.format(
    "((s.sale_price_usd - a.price_usd) * CAST(100 AS DOUBLE) / nullif(a.price_usd, 0))"
)

SALES_TRANSFORM = f"""
sales_transform AS (
  SELECT s.sale_id, s.artwork_id, s.sale_date, s.sale_price_usd, s.buyer_country, a.title,
         a.artist_id, a.year AS artwork_year, a.medium, a.price_usd AS list_price_usd,
         upper(trim(r.name, ' ' || chr(9))) AS artist_name, r.nationality,
         s.sale_price_usd - a.price_usd AS price_diff, {PERCENT} AS pct_change
  FROM sales s LEFT JOIN artworks a ON s.artwork_id = a.artwork_id
  LEFT JOIN artists r ON a.artist_id = r.artist_id)"""

WITH_SALES = f"WITH {SALES}, {ARTWORKS}, {ARTISTS}, {SALES_TRANSFORM}"
