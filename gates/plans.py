"""The enriched tables, their outputs and their variants."""

import uuid

from pyspark.sql import functions as F

from gates.registry import query
from gates.roles import (
    ARTISTS,
    ARTWORKS,
    BOUNDS,
    HIGH_VALUE,
    MEDIA,
    SALES,
    WITH_SALES,
    artists,
    artworks,
    media,
    sales,
)
from tablewright import plans
from tablewright.plans.checked import checked_sales_output
from tablewright.quality.contracts import Contract
from tablewright.session import fresh_path, stage


def _sales_transform(t):
    return plans.sales_transform(sales(t), artworks(t), artists(t))


@query(f"{WITH_SALES} SELECT * FROM sales_transform ORDER BY sale_date DESC, sale_id")
def m1_sales_transform(t):
    return _sales_transform(t)


@query(f"{WITH_SALES} SELECT * FROM sales_transform")
def m1_sales_colocated(t):
    """Sales and artworks stored in buckets, joined without moving them."""
    name = f"gate_{uuid.uuid4().hex}"
    stored = plans.store_for_sales(sales(t), artworks(t), fresh_path(t.spark, "buckets"), name, buckets=8)
    return plans.sales_colocated(*stored, artists(t))


@query(f"{WITH_SALES} SELECT * FROM sales_transform WHERE sale_price_usd >= {HIGH_VALUE}")
def m2_sales_output(t):
    return plans.sales_output(_sales_transform(t), HIGH_VALUE)


_TIER = "CASE WHEN price_usd < {0} THEN 'budget' WHEN price_usd < {1} THEN 'mid' ELSE 'premium' END"
_CATALOGUE = f"""
WITH {SALES}, {ARTWORKS}, {ARTISTS}, {MEDIA},
history AS (
  SELECT artwork_id, count(*) AS sale_count, CAST(sum(sale_price_usd) AS BIGINT) AS total,
         round(avg(sale_price_usd), 0) AS avg_sale_price,
         min(sale_date) AS first_sale_date, max(sale_date) AS last_sale_date
  FROM sales GROUP BY artwork_id),
lists AS (
  SELECT artwork_id, CAST(count(*) AS INTEGER) AS media_count,
         min(filename) FILTER (WHERE sort_order = 1) AS primary_image,
         min(alt_text) FILTER (WHERE sort_order = 1) AS primary_image_alt,
         CAST(to_json(list({{'sort_order': sort_order, 'filename': filename,
           'media_type': media_type, 'file_format': file_format, 'width_px': width_px,
           'height_px': height_px, 'file_size_kb': file_size_kb, 'alt_text': alt_text}}
           ORDER BY sort_order)) AS VARCHAR) AS media
  FROM media GROUP BY artwork_id),
artworks_transform AS (
  SELECT a.artwork_id, a.title, a.year, a.medium, a.price_usd AS list_price_usd,
         upper(r.name) AS artist_name, r.nationality, coalesce(h.sale_count, 0) AS sale_count,
         coalesce(h.total, 0) AS total_sales_value, h.avg_sale_price, h.first_sale_date,
         h.last_sale_date, coalesce(h.sale_count, 0) > 0 AS has_sold,
         {_TIER.format(*BOUNDS)} AS price_tier,
         CAST(rank() OVER (ORDER BY coalesce(h.total, 0) DESC) AS INTEGER) AS sales_rank,
         l.primary_image, l.primary_image_alt, coalesce(l.media_count, 0) AS media_count, l.media
  FROM artworks a LEFT JOIN artists r ON a.artist_id = r.artist_id
  LEFT JOIN history h ON a.artwork_id = h.artwork_id
  LEFT JOIN lists l ON a.artwork_id = l.artwork_id)
"""


def _artworks_transform(t, **kwargs):
    return plans.artworks_transform(
        artworks(t), artists(t), sales(t), media(t), bounds=BOUNDS, **kwargs
    )


def _media_as_text(df):
    return df.withColumn("media", F.to_json("media", {"ignoreNullFields": "false"}))


@query(f"{_CATALOGUE} SELECT * FROM artworks_transform")
def m3_artworks_transform(t):
    return _media_as_text(_artworks_transform(t))


@query(f"{_CATALOGUE} SELECT * EXCLUDE (media) FROM artworks_transform")
def m3_artworks_without_media_lists(t):
    return _artworks_transform(t, media_lists=False, ordered=False)


@query(
    f"""
    WITH {MEDIA}
    SELECT artwork_id, CAST(floor((sort_order - 1) / 3) AS BIGINT) AS part, count(*) AS n,
           string_agg(filename, ',' ORDER BY sort_order) AS files
    FROM media GROUP BY artwork_id, floor((sort_order - 1) / 3)
    """
)
def m3_media_parts(t):
    # every artwork counts as one with many media
    parts = plans.media_parts(media(t), part_rows=3, single_task_rows=1)
    files = F.array_join(F.transform("media", lambda m: m["filename"]), ",")
    return parts.select(
        "artwork_id", "part", F.size("media").cast("long").alias("n"), files.alias("files")
    )


@query(f"{_CATALOGUE} SELECT * FROM artworks_transform")
def m3_artworks_transform_distributed(t):
    # the route for more artworks than one task may rank, with dates known to be ISO text
    return _media_as_text(_artworks_transform(t, single_task_rows=100, iso_dates=True))


@query(
    f"""
    {_CATALOGUE}
    SELECT artwork_id, row_number() OVER (ORDER BY total_sales_value DESC, artwork_id) AS sales_rank
    FROM artworks_transform
    """
)
def m3_artworks_ordinal_rank(t):
    ranked = _artworks_transform(t, ties="ordinal", single_task_rows=100)
    return ranked.select("artwork_id", F.col("sales_rank").cast("long").alias("sales_rank"))


@query(f"{_CATALOGUE} SELECT price_tier, count(*) AS count FROM artworks_transform GROUP BY price_tier")
def m4_artworks_output(t):
    return plans.artworks_output(_artworks_transform(t, ordered=False))[1]


@query(
    f"""
    WITH {SALES}, {ARTWORKS}, {ARTISTS}
    SELECT s.sale_id, s.artwork_id, s.sale_date, s.sale_price_usd, s.buyer_country, a.title,
           a.artist_id, a.year AS artwork_year, a.medium, a.price_usd AS list_price_usd,
           upper(trim(r.name, ' ' || chr(9))) AS artist_name, r.nationality,
           s.sale_price_usd - a.price_usd AS price_diff,
           CASE WHEN a.price_usd = 0 THEN
                  CASE WHEN s.sale_price_usd > 0 THEN CAST('inf' AS DOUBLE)
                       WHEN s.sale_price_usd < 0 THEN CAST('-inf' AS DOUBLE)
                       ELSE CAST('nan' AS DOUBLE) END
                ELSE CAST(s.sale_price_usd - a.price_usd AS DOUBLE)
                       / nullif(CAST(a.price_usd AS DOUBLE), 0) * CAST(100 AS DOUBLE) END AS pct_change
    FROM sales s JOIN artworks a ON s.artwork_id = a.artwork_id
    JOIN artists r ON a.artist_id = r.artist_id WHERE s.sale_price_usd > {HIGH_VALUE}
    """
)
def m5_sales_by_threshold(t):
    return plans.sales_by_threshold(sales(t), artworks(t), artists(t), HIGH_VALUE)


@query(
    f"""
    WITH {SALES}, {ARTWORKS}, {ARTISTS}, {MEDIA},
    history AS (
      SELECT artwork_id, count(*) AS sale_count, CAST(sum(sale_price_usd) AS BIGINT) AS total,
             avg(sale_price_usd) AS avg_sale_price,
             min(sale_date) AS first_sale_date, max(sale_date) AS last_sale_date
      FROM sales GROUP BY artwork_id),
    images AS (
      SELECT artwork_id, count(*) AS media_count,
             min(filename) FILTER (WHERE sort_order = 1) AS primary_image,
             min(alt_text) FILTER (WHERE sort_order = 1) AS primary_image_alt
      FROM media GROUP BY artwork_id),
    rows AS (
      SELECT a.artwork_id, a.title, a.year, a.medium, a.price_usd AS list_price_usd,
             upper(trim(r.name, ' ' || chr(9))) AS artist_name, r.nationality,
             coalesce(h.sale_count, 0) AS sale_count, coalesce(h.total, 0) AS total_sales_value,
             h.avg_sale_price, h.first_sale_date, h.last_sale_date, h.sale_count > 0 AS has_sold,
             CASE WHEN price_usd <= {BOUNDS[0]} THEN 'budget' WHEN price_usd <= {BOUNDS[1]} THEN 'mid'
                  ELSE 'premium' END AS price_tier
      FROM artworks a JOIN artists r ON a.artist_id = r.artist_id
      LEFT JOIN history h ON a.artwork_id = h.artwork_id)
    SELECT rows.*, row_number() OVER (PARTITION BY price_tier
             ORDER BY total_sales_value DESC, rows.artwork_id) AS sales_rank,
           primary_image, primary_image_alt, media_count
    FROM rows LEFT JOIN images ON rows.artwork_id = images.artwork_id
    """
)
def m6_artworks_by_tier(t):
    return plans.artworks_by_tier(
        artworks(t), artists(t), sales(t), media(t), BOUNDS, single_task_rows=100, iso_dates=True
    )


CHECKED = Contract.from_dict(
    {
        "dataset": "sales_transform",
        "columns": [
            {
                "name": "sale_price_usd",
                "checks": [
                    {"missing": {"must_be": 0}},
                    {"invalid": {"must_be": 0, "valid_min": 1}},
                ],
            },
        ],
        "checks": [{"row_count": {"must_be_greater_than": 0}}],
    }
)


@query(
    f"""
    {WITH_SALES}
    SELECT * EXCLUDE (price_diff), price_diff AS price_difference FROM sales_transform
    WHERE sale_price_usd >= {HIGH_VALUE}
    """
)
def m7_checked_sales_output(t):
    transformed = stage(
        plans.sales_transform(sales(t), artworks(t), artists(t), ordered=False), "sales"
    )
    path = fresh_path(t.spark, "checked-sales")
    checked_sales_output(transformed, path, CHECKED, HIGH_VALUE)
    schema = transformed.withColumnRenamed("price_diff", "price_difference").schema
    return t.spark.read.schema(schema).json(path)
