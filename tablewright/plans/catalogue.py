"""Enriched catalogue: each artwork with its sales history, rank and media.

Inputs are those of the sales plan and

* media: artwork_id, sort_order, filename, media_type, file_format, width_px,
  height_px, file_size_kb, alt_text
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions import normalise_name, price_tier, upper
from tablewright.functions.conditional import TIER_BOUNDS, TIER_NAMES
from tablewright.operators.aggregates import (
    first_match,
    ordered_struct_parts,
    sales_per_item,
    struct_list,
    value_counts,
)
from tablewright.operators.ordering import sort_rows
from tablewright.operators.windows import number_rows, rank_rows
from tablewright.quality.schema import Field, TableSchema
from tablewright.session import SINGLE_TASK_ROWS, stage

# Fields of a media entry; columns, types and rules of the catalogue.
MEDIA_FIELDS = (
    "sort_order",
    "filename",
    "media_type",
    "file_format",
    "width_px",
    "height_px",
    "file_size_kb",
    "alt_text",
)

ARTWORKS_SCHEMA = TableSchema(
    "artworks_transform",
    {
        "artwork_id": Field("bigint"),
        "title": Field("string"),
        "year": Field("double", nullable=True),
        "medium": Field("string"),
        "list_price_usd": Field("bigint", gt=0),
        "artist_name": Field("string"),
        "nationality": Field("string"),
        "sale_count": Field("bigint", ge=0),
        "total_sales_value": Field("double", ge=0),
        "avg_sale_price": Field("double", nullable=True),
        "first_sale_date": Field("string", nullable=True),
        "last_sale_date": Field("string", nullable=True),
        "has_sold": Field("boolean"),
        "price_tier": Field("string", isin=TIER_NAMES),
        "sales_rank": Field("int", ge=1),
        "primary_image": Field("string", nullable=True),
        "primary_image_alt": Field("string", nullable=True),
        "media_count": Field("int", ge=0),
    },
)


def catalogue(
    artworks: DataFrame, artists: DataFrame, artist_name: Column, how: str = "left"
) -> DataFrame:
    """Artworks with nationality and artist name, which is edited once per artist."""
    makers = artists.select("artist_id", artist_name.alias("artist_name"), "nationality")
    return artworks.join(makers, "artist_id", how).select(
        "artwork_id",
        "title",
        "year",
        "medium",
        F.col("price_usd").alias("list_price_usd"),
        "artist_name",
        "nationality",
    )


def with_sales(
    items: DataFrame, sales: DataFrame, digits: int | None = 0, iso_dates: bool = False
) -> DataFrame:
    """Add the sales history of each artwork.

    Sales of unknown artworks need no filter of their own: their groups find no
    artwork to join. Dates are text and compared as such; ``iso_dates`` says that
    all are ISO dates, which saves a sort of all sales.
    """
    history = sales_per_item(
        sales, "artwork_id", "sale_price_usd", "sale_date", digits, iso_text=iso_dates
    )
    return items.join(history, "artwork_id", "left")


def media_summary(
    media: DataFrame, fields: Sequence[str] = MEDIA_FIELDS, lists: bool = True
) -> DataFrame:
    """Number of media, the primary image and the ordered media list, per artwork.

    The primary image is the one with sort order 1; among several, the one with
    the smallest file name. Without lists, the media are counted by a hash
    aggregate over the key alone, and only the few with sort order 1 are sorted.
    """
    picked = {"primary_image": "filename", "primary_image_alt": "alt_text"}
    order = ["filename", "alt_text"]
    counted = F.count(F.lit(1)).cast("int").alias("media_count")
    if not lists:
        leading = media.filter("sort_order = 1").groupBy("artwork_id")
        primary = leading.agg(first_match(picked, "true", order).alias("__primary"))
        counts = media.groupBy("artwork_id").agg(counted)
        return counts.join(primary, "artwork_id", "left").select(
            "artwork_id", *[F.col(f"__primary.{n}").alias(n) for n in picked], "media_count"
        )
    primary = first_match(picked, "sort_order = 1", order).alias("__primary")
    listed = struct_list("sort_order", fields).alias("media")
    summary = media.groupBy("artwork_id").agg(primary, counted, listed)
    return summary.select("artwork_id", "__primary.*", "media_count", "media")


def media_parts(
    media: DataFrame, part_rows: int = 10_000, fields: Sequence[str] = MEDIA_FIELDS, **kwargs
) -> DataFrame:
    """The media lists in parts: ``artwork_id``, ``part``, ``media``.

    For artworks with more media than one cell may hold; go with
    ``artworks_transform(…, media_lists=False)``.
    """
    order = ["sort_order", *[f for f in fields if f != "sort_order"]]
    return ordered_struct_parts(
        media, "artwork_id", order, fields, "media", part_rows, unique=False, **kwargs
    )


def artworks_transform(
    artworks: DataFrame,
    artists: DataFrame,
    sales: DataFrame,
    media: DataFrame,
    how: str = "left",
    bounds: Sequence[float] = TIER_BOUNDS,
    ties: str = "rank",
    ordered: bool = True,
    media_lists: bool = True,
    single_task_rows: int = SINGLE_TASK_ROWS,
    iso_dates: bool = False,
) -> DataFrame:
    """The enriched catalogue, by total sales value and then by id.

    ``ties="rank"`` gives artworks with equal totals the same rank;
    ``ties="ordinal"`` numbers them by id. ``media_lists=False`` leaves the media
    column out (see ``media_parts``): a list is one cell, so take it for
    works whose media fit one. ``iso_dates`` is that of ``with_sales``. Above
    ``single_task_rows`` artworks the sales history is stored, ranks are made of
    ids and totals alone and meet the wide rows by id.
    """
    if ties not in ("rank", "ordinal"):
        raise ValueError("ties must be rank or ordinal")
    items = catalogue(artworks, artists, upper("name"), how)
    bound = artworks.count()
    narrow = bound > single_task_rows
    rows = with_sales(items, sales, iso_dates=iso_dates)
    if narrow:
        rows = stage(rows, "catalogue")
    rows = rows.withColumns(
        {
            "has_sold": F.coalesce(F.col("sale_count") > 0, F.lit(False)),
            "sale_count": F.coalesce("sale_count", F.lit(0)).cast("long"),
            "total_sales_value": F.coalesce("total_sales_value", F.lit(0)),
            "price_tier": price_tier("list_price_usd", bounds),
        }
    )
    to_rank = rows.select("artwork_id", "total_sales_value") if narrow else rows
    if ties == "rank":
        ranked = rank_rows(
            to_rank,
            "total_sales_value",
            "sales_rank",
            row_bound=bound,
            single_task_rows=single_task_rows,
        )
    else:
        ranked = number_rows(
            to_rank,
            ["total_sales_value desc", "artwork_id"],
            "sales_rank",
            row_bound=bound,
            single_task_rows=single_task_rows,
        )
    if narrow:
        ranked = rows.join(ranked.select("artwork_id", "sales_rank"), "artwork_id")
    listed = ["media"] if media_lists else []
    result = (
        ranked.join(media_summary(media, lists=media_lists), "artwork_id", "left")
        .withColumns(
            {
                "media_count": F.coalesce("media_count", F.lit(0)),
                "sales_rank": F.col("sales_rank").cast("int"),
            }
        )
        .select(*ARTWORKS_SCHEMA.fields, *listed)
    )
    return sort_rows(result, "total_sales_value desc", "artwork_id") if ordered else result


def artworks_output(transformed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The catalogue to publish, and how many artworks each price tier holds."""
    return transformed, value_counts(transformed, "price_tier")


def artworks_by_tier(
    artworks: DataFrame,
    artists: DataFrame,
    sales: DataFrame,
    media: DataFrame,
    bounds: Sequence[float] = TIER_BOUNDS,
    single_task_rows: int = SINGLE_TASK_ROWS,
    iso_dates: bool = False,
) -> DataFrame:
    """The variant ranked within price tiers.

    Inner join to artists, stripped names, unrounded averages, a price on a
    bound in the lower tier, an ordinal rank per tier (ties by id), no flag
    instead of ``false`` for unsold artworks, no media list, and a null count
    without media. Image and caption are the smallest present ones among the
    media with sort order 1.
    """
    items = catalogue(artworks, artists, normalise_name("name"), "inner")
    rows = with_sales(items, sales, digits=None, iso_dates=iso_dates).withColumns(
        {
            "has_sold": F.col("sale_count") > 0,
            "sale_count": F.coalesce("sale_count", F.lit(0)).cast("long"),
            "total_sales_value": F.coalesce("total_sales_value", F.lit(0)),
            "price_tier": price_tier("list_price_usd", bounds, inclusive=True),
        }
    )
    bound = artworks.count()
    if bound > single_task_rows:
        rows = stage(rows, "catalogue-tiers")
    ranked = number_rows(
        rows,
        ["total_sales_value desc", "artwork_id"],
        "sales_rank",
        ["price_tier"],
        row_bound=bound,
        single_task_rows=single_task_rows,
    )
    # all media are counted by hash; only those that may give an image are sorted
    counts = media.groupBy("artwork_id").agg(F.count(F.lit(1)).alias("media_count"))
    images = media.filter("sort_order = 1").groupBy("artwork_id").agg(
        F.min("filename").alias("primary_image"), F.min("alt_text").alias("primary_image_alt")
    )
    found = counts.join(images, "artwork_id", "left")
    columns = [*ranked.columns, "primary_image", "primary_image_alt", "media_count"]
    return ranked.join(found, "artwork_id", "left").select(*columns)
